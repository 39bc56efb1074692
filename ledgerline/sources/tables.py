"""Reading the given Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; callers select the columns they need so the scan is pruned."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
