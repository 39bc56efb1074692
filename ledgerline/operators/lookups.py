"""Dimension lookup and cohort membership joins.

``lookup_profiles`` attaches per-user attributes to events. Whether the profiles
are broadcast is left to the engine, which knows their size in bytes (from
statistics, or measured at run time): above its threshold the join is a shuffle
join, whose skewed partitions adaptive execution splits.

``in_cohort`` keeps the rows of a grid whose (key, period) is in a cohort -
a left semi join, which never multiplies rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def lookup_profiles(events: DataFrame, profiles: DataFrame, key: str = "user_id") -> DataFrame:
    return events.join(profiles, key, "left")


def in_cohort(grid: DataFrame, cohort: DataFrame, keys) -> DataFrame:
    return grid.join(cohort.select(*keys), list(keys), "left_semi")
