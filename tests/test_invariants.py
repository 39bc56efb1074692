"""Invariants of the models on the driver's smallest tables (sf0.001)."""

import datetime as dt
from decimal import Decimal

from fixtures import CHURN_A, ENG_A, REV_A, SUB_A, feeds, with_
from pyspark.sql import functions as F

from ledgerline.operators import audits, spine
from ledgerline.plans import faults, materialize
from ledgerline.plans.catalog import DATA_SPINE
from ledgerline.plans.customer_summary import OUTPUT_COLUMNS, SORT_KEYS, customer_summary, filled, unfilled_summary
from ledgerline.session import work_dir
from ledgerline.sources.feeds import load_feeds


def _months(start, end):
    return (end.year - start.year) * 12 + end.month - start.month + 1


def test_grid_rows_equal_users_times_months(spark, sf_small):
    f = load_feeds(spark, sf_small)
    users = spine.distinct_users(f).count()
    m1 = customer_summary(f, *DATA_SPINE)
    assert m1.count() == users * _months(*DATA_SPINE)
    assert m1.select("user_id", "year", "month").distinct().count() == m1.count()


def test_filled_columns_have_no_nulls(spark, sf_small):
    m1 = customer_summary(load_feeds(spark, sf_small), *DATA_SPINE)
    nulls = m1.select(*[F.sum(F.col(c).isNull().cast("int")).alias(c) for c, _ in OUTPUT_COLUMNS]).first()
    assert all(v == 0 for v in nulls.asDict().values())


def test_forms_are_equal(spark, sf_small):
    f = faults.with_violations(load_feeds(spark, sf_small))  # with events of no user
    a, b, c = (customer_summary(f, dt.date(1998, 1, 1), dt.date(1998, 12, 1), form=form) for form in ("star", "stacked", "grid"))
    for x in (b, c):
        assert a.exceptAll(x).count() == 0 and x.exceptAll(a).count() == 0


def test_month_sums_equal_raw_sums_inside_spine(spark, sf_small):
    f = load_feeds(spark, sf_small)
    m1 = customer_summary(f, *DATA_SPINE)
    got = m1.agg(F.sum("total_payment_amount").alias("p"), F.sum("total_login_count").alias("l")).first()
    raw_p = f["revenue"].agg(F.sum("payment_amount")).first()[0]
    raw_l = f["engagement"].agg(F.sum("login_count")).first()[0]
    assert got.p == raw_p and got.l == raw_l
    assert isinstance(got.p, Decimal)


SHORT_SPINE = dt.date(2023, 11, 1), dt.date(2024, 6, 1)


def _few(spark):
    """Users with events in, before and after the spine, and only outside it; events of no user."""
    subs = [with_(SUB_A, subscription_id=f"s{i}", user_id=u, event_time=f"{at}T00:00:00")
            for i, (u, at) in enumerate([("b", "2024-01-03"), ("b", "2023-01-03"), ("a", "2024-06-30"), ("c", "2022-05-05"), ("c", "2025-05-05")])]
    f = feeds(spark, subs, [with_(REV_A, revenue_id="r", user_id="b", event_time="2024-03-02T00:00:00")], [CHURN_A], [ENG_A])
    f["subscription"] = f["subscription"].withColumn("user_id", F.when(F.col("subscription_id") != "s2", F.col("user_id")))
    return f


def _exchange_below_grid(plan, exchange):
    """Whether each such shuffle lies below (in the text: after) the step that makes the grid."""
    plan = plan.split("Initial Plan")[0]
    return 0 <= plan.find("Generate explode(sequence(") < plan.find(exchange)


def test_sorted_summary_deals_month_rows_not_the_grid(spark):
    f = _few(spark)
    ordered = customer_summary(f, *SHORT_SPINE, sort=True)
    assert _exchange_below_grid(ordered._jdf.queryExecution().executedPlan().toString(), "Exchange rangepartitioning")
    rows = ordered.withColumn("_at", F.monotonically_increasing_id()).orderBy("_at").drop("_at").collect()
    assert rows == customer_summary(f, *SHORT_SPINE, form="star", sort=True).collect()
    assert [tuple(r[k] or "" for k in SORT_KEYS) for r in rows] == sorted(tuple(r[k] or "" for k in SORT_KEYS) for r in rows)


def test_summary_is_written_from_narrow_rows(spark):
    f = _few(spark)
    narrow, whole = unfilled_summary(f, *SHORT_SPINE), customer_summary(f, *SHORT_SPINE)
    assert len(narrow.columns) == 5 and filled(narrow).schema.names == whole.columns
    path = work_dir(spark, "test-narrow")
    materialize.write_model(narrow, path, finish=filled)
    stored = spark.read.parquet(path).select(*whole.columns)
    assert stored.dtypes == whole.dtypes and sorted(map(str, stored.collect())) == sorted(map(str, whole.collect()))
    lines = materialize._clustered(narrow, materialize.PARTITION_COLUMNS, ("user_id",), finish=filled)._jdf.queryExecution().optimizedPlan().toString().split("\n")
    below = next(i for i, line in enumerate(lines) if "RebalancePartitions" in line)
    assert any("coalesce(_values" in line for line in lines[:below]) and not any("N/A" in line for line in lines[below:])


def test_numbering_leaves_rows_where_they_are(spark):
    from ledgerline.plans.catalog import _numbered

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables that are not small
    try:
        ordered = customer_summary(_few(spark), *SHORT_SPINE, sort=True)
        numbered = _numbered(ordered)
        assert "SortMergeJoin" not in numbered._jdf.queryExecution().executedPlan().toString()
        rows = numbered.orderBy("row_no").collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [r.row_no for r in rows] == list(range(1, 1 + ordered.count()))
    assert [tuple(r[k] or "" for k in SORT_KEYS) for r in rows] == sorted(tuple(r[k] or "" for k in SORT_KEYS) for r in rows)


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_empty_months_are_made_beside_the_months_with_events(spark):
    plan = _optimized(customer_summary(_few(spark), *SHORT_SPINE))
    narrow = plan[plan.index("Window ["):]
    assert plan.index("Union") < plan.index("Window [") and "min(struct" not in narrow  # what is put in order by user holds no roll-up


def test_audits_of_months_with_events_make_no_others(spark, sf_small):
    m1 = customer_summary(faults.with_violations(load_feeds(spark, sf_small)), *DATA_SPINE)
    for name in ("churn_risk_within_range", "engagement_score_range", "allowed_repayment_and_trend_skip_gaps"):
        found = audits.violations(m1, name)
        assert "Generate explode(sequence(" not in _optimized(found) and not found.isEmpty()
    assert "Generate explode(sequence(" in _optimized(audits.violations(m1, "allowed_repayment_and_trend"))


def test_events_with_picks_are_sorted_once(spark, sf_small):
    from ledgerline.plans.customer_summary import _rolled_up

    f = load_feeds(spark, sf_small)
    for part in _rolled_up(f)[:2]:
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "REPARTITION_BY_NUM" in plan and plan.index("SortAggregate") < plan.rindex("SortAggregate") < plan.index("Exchange")


def test_older_version_reads_a_feed_once(spark):
    f = _few(spark)
    f["revenue"] = f["revenue"].unionByName(f["revenue"].withColumn("event_time", F.lit(None).cast("timestamp")))
    for name, rows in faults.another_version(f, "2024-01", "2003-01").items():
        assert "Union" not in _optimized(rows) or name == "revenue" and _optimized(rows).count("Union") == 1
        assert rows.where("event_time is null or event_time between '2024-01-01' and '2024-01-31 23:59:59'").isEmpty()
    old = faults.another_version(f, "2024-01", "2003-01")["subscription"]
    assert sorted(str(r.event_time) for r in old.select("event_time").collect()) == [
        "2003-01-03 00:00:00", "2022-05-05 00:00:00", "2023-01-03 00:00:00", "2024-06-30 00:00:00", "2025-05-05 00:00:00"]
