"""Helpers that the corpus operators share."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import shuffles_dropped, work_dir  # noqa: F401 (operators take both from here)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The characters of [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the cluster's shared folder and read back.

    The table survives lost executors and cuts the lineage above it.
    """
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(name: str, columns: list[str]) -> str:
    """``name``, with as many underscores before it as make it none of ``columns`` (case apart)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z; all other letters stay as they are."""
    return F.translate(text, UPPER, LOWER)


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32(doc_id as text) mod ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def row_hash(*cols: Column) -> Column:
    """64-bit hash that tells null from empty."""
    parts: list[Column] = []
    for c in cols:
        parts += [c.isNull(), c]
    return F.xxhash64(*parts)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def blocks(texts: list[str | None], most: int) -> Iterator[tuple[int, int]]:
    """Runs [a, b) of ``texts`` of about ``most`` characters at most; a longer text is a run of its own."""
    a, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t is not None else 0
        if i > a and size + n > most:
            yield a, i
            a, size = i, 0
        size += n
    if a < len(texts):
        yield a, len(texts)
