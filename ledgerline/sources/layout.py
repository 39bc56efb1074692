"""How rows are spread over files when a partitioned table is written.

Rows are clustered by the table's partition columns with a REBALANCE hint: adaptive
execution measures the shuffle and cuts a large partition (a hot month, whoever
its users are) into pieces of the advisory size, and merges small ones, so the number
of tasks and files follows the bytes written and no width has to be chosen. The cut is
between map tasks' outputs, so it needs no sampling pass. ``maxRecordsPerFile`` bounds
files as well where adaptive execution is off; rows are whole either way.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.readwriter import DataFrameWriter

ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
MAX_RECORDS = 5_000_000
#: Codec of tables that are kept: three quarters of the size that the default has.
CODEC = "zstd"


@contextmanager
def partition_bytes(spark: SparkSession, size: int | None) -> Iterator[None]:
    """Shuffle partitions of about ``size`` bytes while a write runs (None: as the session has it)."""
    if size is None:
        yield
        return
    before = spark.conf.get(ADVISORY)
    spark.conf.set(ADVISORY, str(size))
    try:
        yield
    finally:
        spark.conf.set(ADVISORY, before)


def rebalanced(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.hint("rebalance", *columns)


def partitioned_writer(df: DataFrame, columns: Sequence[str], max_records: int = MAX_RECORDS) -> DataFrameWriter:
    """A writer that overwrites, into folders of the given columns."""
    return df.write.mode("overwrite").option("maxRecordsPerFile", max_records).option("compression", CODEC).partitionBy(*columns)
