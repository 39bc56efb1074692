"""What goes to disk: one narrow deal a feed, roll-ups put side by side where they are, shuffle files that go when a table is written."""

import datetime as dt
import time

from fixtures import CHURN_A, ENG_A, REV_A, SUB_A, feeds, with_
from pyspark.sql import functions as F

from ledgerline.operators import rollups
from ledgerline.plans import materialize
from ledgerline.plans.catalog import QUERIES
from ledgerline.plans.customer_summary import customer_summary
from ledgerline.session import work_dir
from ledgerline.sources.feeds import load_feeds

SPINE = dt.date(2019, 3, 1), dt.date(2024, 12, 1)  # 70 months: two words of notes, from the middle of a year


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_grid_deals_each_feed_once(spark, sf_small):
    """On top of what the feeds' own joins need: one shuffle for each feed, none for users, months or empty months."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        alone = sum(_exchanges(df) for df in load_feeds(spark, sf_small).values())
        assert _exchanges(QUERIES["customer_summary"](spark, sf_small)) == alone + 4
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _odd_feeds(spark):
    """Users with all, some and no months inside the spine, events without user or time, months in both words of the notes."""
    subs = [with_(SUB_A, subscription_id=f"s{i}", user_id=u, event_time=t) for i, (u, t) in enumerate([
        ("a", "2019-03-01T00:00:00"), ("a", "2024-12-31T23:59:59"), ("b", "2010-01-01T00:00:00"), ("a", "2024-06-05T00:00:00"), ("a", "2024-06-05T00:00:00"), ("e", "2024-07-01T00:00:00")])]
    revs = [with_(REV_A, revenue_id=f"r{i}", user_id=u, event_time=t) for i, (u, t) in enumerate([
        ("a", "2024-06-07T00:00:00"), ("c", "2024-08-01T00:00:00"), ("c", "2030-01-01T00:00:00"), ("d", "2024-07-01T00:00:00"), ("f", "2024-07-02T00:00:00")])]
    found = feeds(spark, subs, revs, [with_(CHURN_A, user_id="c", event_time="2024-08-09T00:00:00")], [with_(ENG_A, user_id="d", event_time="2019-12-09T00:00:00")])
    found["subscription"] = found["subscription"].withColumn("user_id", F.when(F.col("user_id") != "e", F.col("user_id")))
    found["revenue"] = found["revenue"].withColumn("event_time", F.when(F.col("user_id") != "f", F.col("event_time")))
    return found


def test_grid_of_odd_rows_is_the_star(spark):
    rows = _odd_feeds(spark)
    noted, grid, star = (customer_summary(rows, *SPINE, form=form) for form in ("noted", "grid", "star"))
    for other in (noted, grid):
        assert other.columns == star.columns and other.count() == star.count() == 6 * 70  # a, b, c, d, f and events without a user
        assert other.exceptAll(star).isEmpty() and star.exceptAll(other).isEmpty()


def test_stored_grid_of_odd_rows_is_the_star(spark):
    from ledgerline.plans.customer_summary import filled, unfilled_summary

    rows, path = _odd_feeds(spark), work_dir(spark, "test-narrow")
    materialize.write_model(unfilled_summary(rows, *SPINE), path, finish=filled)
    star = customer_summary(rows, *SPINE, form="star")
    stored = spark.read.parquet(path).select(*star.columns)
    assert stored.count() == 6 * 70 and stored.exceptAll(star).isEmpty() and star.exceptAll(stored).isEmpty()


def test_roll_ups_side_by_side(spark):
    a = spark.createDataFrame([("u", 2024, 1, "x", 1), ("u", 2024, 2, None, 2), (None, 2024, 1, "n", 4)], "user_id string, year int, month int, p string, bits long")
    b = spark.createDataFrame([("u", 2024, 1, 7, 8), ("v", None, None, 9, None)], "user_id string, year int, month int, q int, bits long")
    got = rollups.side_by_side([a, b], bits=["bits"])
    assert got.columns == ["user_id", "year", "month", "p", "q", "bits"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([
        ("u", 2024, 1, "x", 7, 9), ("u", 2024, 2, None, None, 2), (None, 2024, 1, "n", None, 4), ("v", None, None, None, 9, None)], key=repr)


def _shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {str(blocks.apply(i)) for i in range(blocks.size()) if str(blocks.apply(i)).startswith("shuffle_")}


def test_written_models_leave_no_shuffle_files(spark):
    rows = spark.range(1000).select(F.col("id").cast("string").alias("user_id"), F.lit(2024).alias("year"), (F.col("id") % 12 + 1).cast("int").alias("month"))
    before = _shuffle_files(spark)
    materialize.write_model(rows.groupBy(*rows.columns).agg(F.count("*").alias("n")), work_dir(spark, "test-shuffles"))
    for _ in range(50):
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left
