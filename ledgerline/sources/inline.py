"""Inline rows as a feed (test inputs written as literal rows).

Rows are dicts keyed by column name; missing keys are NULL. Timestamps may be
given as ISO text (with or without ' UTC', with microseconds) or datetimes,
and NUMERIC values as numbers or text; everything is cast to the feed's
declared types.
"""

from __future__ import annotations

import datetime as dt
import decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.sources.schemas import Feed


def _text(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, (int, float, decimal.Decimal)):
        return repr(v) if isinstance(v, float) else str(v)
    return str(v)


def feed_from_rows(spark: SparkSession, feed: Feed, rows: list[dict]) -> DataFrame:
    text_schema = T.StructType([T.StructField(c, T.StringType(), True) for c in feed.columns])
    data = [tuple(_text(r.get(c)) for c in feed.columns) for r in rows]
    df = spark.createDataFrame(data, text_schema)
    return df.select(*[F.col(c).cast(t).alias(c) for c, t, _ in feed.fields])
