"""Entity and period spines.

* ``distinct_users``: every user seen in any feed (UNION DISTINCT).
* ``calendar``: users x months with year, month and 'yyyy-MM' text. The month
  list is a constant array (folded at planning), exploded per user, so this
  is a per-row generate, not a cross join.
* ``day_spine``: per user, every day from the first to the last active day within given days.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import timefns


def distinct_users(feeds: dict[str, DataFrame]) -> DataFrame:
    """user_id of every feed, duplicates removed (partial distinct per task first)."""
    parts = [df.select("user_id") for df in feeds.values()]
    return reduce(DataFrame.union, parts).distinct()


def calendar(users: DataFrame,
             start: dt.date = timefns.DEFAULT_SPINE_START,
             end: dt.date = timefns.DEFAULT_SPINE_END) -> DataFrame:
    """users x months in [start, end] -> user_id, year, month, month_year.

    The user list is small next to the grid it expands into (one row per
    month), so AQE would coalesce its shuffle to very few partitions and the
    explode would then run in those few tasks. Spreading the users round-robin
    over ``spark.sql.shuffle.partitions`` first (an explicit count, which AQE
    keeps; a hash on user_id would be folded into the distinct's own shuffle)
    runs the expansion in all tasks.
    """
    n = int(users.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return users.repartition(n).select("user_id", F.inline(timefns.month_rows(start, end)))


def day_spine(events: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Per user, one row per calendar day between their first and last event day in [first, last].

    The span per user is found with one aggregate (partial per task), then
    each user's day list is generated from its two bounds; a stray event of
    year 1 or 9999 lies outside the given days and so can't stretch it.
    """
    day = F.to_date("event_time")
    bounds = events.where(day.between(F.lit(first), F.lit(last))).groupBy("user_id").agg(
        F.min("event_time").alias("_first"), F.max("event_time").alias("_last"))
    return (
        bounds.select(
            "user_id",
            F.explode(timefns.day_sequence(F.to_date("_first"), F.to_date("_last"))).alias("day"),
        )
        .select("user_id", "day", timefns.month_year("day").alias("month_year"))
    )
