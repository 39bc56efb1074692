"""Numbered commits: small tables, each written as one file in a folder of its own.

The file's rename at the end of the write is the commit, so a reader finds a commit whole or
not at all, on any file system Spark writes to. The newest number wins. Two writers
of one number: the second fails, because the folder must not exist.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import folder_exists


def last_commit(spark: SparkSession, path: str, schema: str) -> int:
    """The newest commit's number, 0 without any."""
    if not folder_exists(spark, path):
        return 0
    return spark.read.schema(f"{schema}, commit bigint").parquet(path).agg(F.max("commit")).first()[0] or 0


def read_commit(spark: SparkSession, path: str, schema: str, n: int | None = None) -> DataFrame:
    """The rows of a commit (the newest); none without commits."""
    n = last_commit(spark, path, schema) if n is None else n
    if not n:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/commit={n}")


def write_commit(rows: DataFrame, path: str, n: int) -> None:
    rows.coalesce(1).write.mode("errorifexists").parquet(f"{path}/commit={n}")
