"""Plan properties that matter at scale: pushdown, pruning, no Python in the
hot path, one scan or shuffle a feed, and no pair product in model 2."""

import datetime as dt
import itertools
from decimal import Decimal

import pandas as pd
from fixtures import REV_A, SUB_A, feeds, with_

from ledgerline.functions.timefns import month_range
from ledgerline.plans.catalog import QUERIES
from ledgerline.plans.subscription_revenue import subscription_revenue_summary
from ledgerline.session import work_dir
from ledgerline.sources.feeds import churn_feed
from ledgerline.streaming.ingest import with_partitions


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_month_range_reaches_the_scan(spark, sf_small):
    path = work_dir(spark, "test-prune")
    with_partitions(churn_feed(spark, sf_small)).write.partitionBy("year", "month").parquet(path)
    t = spark.read.parquet(path)
    sliced = t.where(month_range("event_time", dt.date(2024, 1, 1), dt.date(2024, 1, 1)))
    plan = _plan(sliced)
    assert "GreaterThanOrEqual(event_time" in plan and "LessThan(event_time" in plan
    assert sliced.count() == t.where("year = 2024 AND month = 1").count() > 0
    # Partition columns prune directories.
    pruned = t.where("year = 2024 AND month = 2")
    assert "PartitionFilters: [isnotnull(year" in _plan(pruned) and pruned.count() == 0


def test_scans_read_only_needed_columns(spark, sf_small):
    plan = _plan(QUERIES["customer_summary"](spark, sf_small))
    lineitem_schemas = [s for s in plan.split("ReadSchema: ")[1:] if "l_orderkey" in s]
    assert lineitem_schemas
    for s in lineitem_schemas:
        schema = s.split("\n")[0]
        assert "l_tax" not in schema  # only repayment_percentage uses it; M1 does not


def test_no_python_in_model_plans(spark, sf_small):
    for name in ("customer_summary", "customer_summary_stacked", "subscription_revenue_summary",
                 "json_ingest_valid", "replay_dedup", "audit_counts_customer"):
        plan = _plan(QUERIES[name](spark, sf_small))
        assert "EvalPython" not in plan and "PythonUDF" not in plan, name


def test_feeds_are_scanned_once(spark, sf_small):
    """Model 1 reads each feed's tables once; building it runs no job but one a table for its schema."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "building a query")
    df = QUERIES["customer_summary"](spark, sf_small)
    assert len(tracker.getJobIdsForGroup("building")) <= 8
    spark.sparkContext.setJobGroup("other", "other")
    assert _plan(df).count("FileScan parquet") == 8 and _plan(df).count("CartesianProduct") == 0


def test_model2_deals_each_feed_once(spark, sf_small):
    """On top of what the feeds' own joins need: one shuffle for each feed, none for the second level or the join."""
    from ledgerline.sources.feeds import load_feeds

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        f = load_feeds(spark, sf_small, names=("subscription", "revenue"))
        feeds_alone = sum(_plan(df).count("Exchange hashpartitioning") for df in f.values())
        assert _plan(subscription_revenue_summary(f)).count("Exchange hashpartitioning") == feeds_alone + 2
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_mean_keeps_all_places(spark):
    from ledgerline.functions.picks import decimal_mean
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("0.125",), ("0.125",), ("0.126",)], "x string").select(F.col("x").cast("decimal(38,9)"))
    out = df.agg(decimal_mean("x").alias("m"))
    assert dict(out.dtypes)["m"] == "decimal(38,9)" and out.first()["m"] == Decimal("0.125333333")


def test_shared_folder_is_required_on_a_cluster():
    from types import SimpleNamespace

    import pytest

    from ledgerline.session import checkpoint_root

    conf = SimpleNamespace(get=lambda k, d=None: d)
    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None, getConf=lambda: conf)
    with pytest.raises(RuntimeError):
        checkpoint_root(SimpleNamespace(sparkContext=sc))


def _brute_force_m2(subs, revs):
    """The model SQL literally: per-timestamp roll-ups, pair join, regroup by day."""
    s = pd.DataFrame(subs)
    r = pd.DataFrame(revs)
    for d in (s, r):
        d["event_time"] = pd.to_datetime(d["event_time"])
        d["year"], d["month"] = d.event_time.dt.year, d.event_time.dt.month
    s_ts = s.sort_values(["event_time", "subscription_id"]).groupby(["user_id", "event_time"]).agg(
        year=("year", "first"), month=("month", "first"), plan=("subscription_plan", "first"),
        annual=("annualized_revenue", lambda x: sum(Decimal(str(v)) for v in x))).reset_index()
    r_ts = r.sort_values(["event_time", "revenue_id"]).groupby(["user_id", "event_time"]).agg(
        year=("year", "first"), month=("month", "first"),
        pay=("payment_amount", lambda x: sum(Decimal(str(v)) for v in x))).reset_index()
    pairs = s_ts.merge(r_ts, on=["user_id", "year", "month"], suffixes=("_s", "_r"))
    pairs["event_date"] = pairs.event_time_r.dt.normalize()
    out = {}
    for key, g in pairs.groupby(["user_id", "event_date"]):
        first_s = g.sort_values("event_time_s").iloc[0]
        first_r = g.sort_values("event_time_r").iloc[0]
        out[key] = (first_s.plan, first_s.annual, first_r.pay)
    return out


def test_model2_matches_brute_force_under_skew(spark):
    """One user with many subscriptions and payments in the same months."""
    subs, revs = [], []
    for i, day in itertools.product(range(12), (1, 9, 17, 25)):
        subs.append(with_(SUB_A, subscription_id=f"s{i}-{day}", user_id="hot",
                          event_time=f"2024-{i % 3 + 1:02d}-{day:02d}T0{i % 10}:00:00",
                          subscription_plan=("basic", "pro", "enterprise")[(i + day) % 3],
                          annualized_revenue=100 + i + day))
    for i, day in itertools.product(range(10), range(1, 28, 3)):
        revs.append(with_(REV_A, revenue_id=f"r{i}-{day}", user_id="hot",
                          event_time=f"2024-{i % 3 + 1:02d}-{day:02d}T{i:02d}:30:00",
                          payment_amount=10 + i))
    subs.append(with_(SUB_A, subscription_id="other", user_id="cold"))
    revs.append(with_(REV_A, revenue_id="other", user_id="cold"))
    got = {(r.user_id, pd.Timestamp(r.event_date)): (r.subscription_plan, r.total_annualized_revenue,
                                                     r.total_payment_amount)
           for r in subscription_revenue_summary(feeds(spark, subs, revs)).collect()}
    want = _brute_force_m2(subs, revs)
    assert len(got) == len(want) > 20
    for k, (plan, annual, pay) in want.items():
        g = got[k]
        assert g[0] == plan and g[1] == annual and g[2] == pay, k


def test_calendar_with_run_time_bounds(spark):
    from pyspark.sql import functions as F

    from ledgerline.operators import spine

    users = spark.createDataFrame([("a",), ("b",)], "user_id string")
    lit = spine.calendar(users, dt.date(2023, 11, 1), dt.date(2024, 2, 1))
    run_time = spine.calendar(users, F.to_date(F.lit("2023-11-15")), F.to_date(F.lit("2024-02-01")))
    assert lit.count() == 8
    assert lit.exceptAll(run_time).count() == 0 and run_time.exceptAll(lit).count() == 0
    assert sorted(r.month_year for r in lit.where("user_id = 'a'").collect()) == [
        "2023-11", "2023-12", "2024-01", "2024-02"]
