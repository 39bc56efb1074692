"""Edge rows E1-E14 from FIXTURES.md section 4."""

import datetime as dt
from decimal import Decimal

from fixtures import CHURN_A, ENG_A, REV_A, SUB_A, feeds, with_
from pyspark.sql import functions as F

from ledgerline.functions import timefns
from ledgerline.operators import audits, dedup
from ledgerline.plans import faults
from ledgerline.plans.catalog import QUERIES
from ledgerline.plans.customer_summary import customer_summary
from ledgerline.plans.subscription_revenue import subscription_revenue_summary
from ledgerline.sources import json_events, schemas
from ledgerline.sources.inline import feed_from_rows


def test_e1_same_day_revenue_keeps_earliest_total(spark):
    revs = [with_(REV_A, revenue_id="r1", event_time="2024-01-20T08:00:00", payment_amount=100.0),
            with_(REV_A, revenue_id="r2", event_time="2024-01-20T17:00:00", payment_amount=900.0)]
    rows = subscription_revenue_summary(feeds(spark, [SUB_A], revs)).collect()
    assert len(rows) == 1
    assert rows[0].total_payment_amount == Decimal("100")


def test_e2_several_subscriptions_in_month_earliest_wins(spark):
    subs = [with_(SUB_A, subscription_id="s2", event_time="2024-01-25T00:00:00", subscription_plan="basic"),
            with_(SUB_A, subscription_id="s1", event_time="2024-01-03T00:00:00", subscription_plan="enterprise")]
    rows = subscription_revenue_summary(feeds(spark, subs, [REV_A])).collect()
    assert len(rows) == 1 and rows[0].subscription_plan == "enterprise"


def test_e3_one_sided_months(spark):
    rev_feb = with_(REV_A, revenue_id="r-feb", event_time="2024-02-10T00:00:00")
    sub_mar = with_(SUB_A, subscription_id="s-mar", event_time="2024-03-10T00:00:00")
    f = feeds(spark, [sub_mar], [rev_feb])
    assert subscription_revenue_summary(f).count() == 0
    m1 = {(r.year, r.month): r for r in customer_summary(f).collect()}
    assert m1[(2024, 2)].total_payment_amount == Decimal("5000")
    assert m1[(2024, 3)].subscription_plan == "pro"


def test_e4_user_only_in_churn_feed(spark):
    f = feeds(spark, churn=[with_(CHURN_A, user_id="only-churn")])
    rows = customer_summary(f).collect()
    assert len(rows) == 84 and {r.user_id for r in rows} == {"only-churn"}


def test_e5_coherent_pick_no_false_consistency_hit(spark):
    revs = [with_(REV_A, revenue_id="r1", event_time="2024-01-05T00:00:00",
                  repayment_status="on_track", payment_delinquency="no_delinquency"),
            with_(REV_A, revenue_id="r2", event_time="2024-01-05T00:00:00",
                  repayment_status="delayed", payment_delinquency="payment_failure")]
    f = feeds(spark, [SUB_A], revs)
    # On the customer grid only the month with events is meaningful (gap months hold 'N/A').
    event_month = customer_summary(f).where("year = 2024 AND month = 1")
    for model in (event_month, subscription_revenue_summary(f)):
        assert audits.violations(model, "repayment_delinquency_consistency").count() == 0
    # Repeatable: the pick is the least (time, id, values) row, r1.
    r = [x for x in customer_summary(f).collect() if (x.year, x.month) == (2024, 1)][0]
    assert r.repayment_status == "on_track"


def test_e6_month_edges(spark):
    revs = [with_(REV_A, revenue_id="r1", event_time="2024-01-31T23:59:59.999999", payment_amount=1.0),
            with_(REV_A, revenue_id="r2", event_time="2024-02-01T00:00:00", payment_amount=2.0)]
    m = {(r.year, r.month): r.total_payment_amount for r in customer_summary(feeds(spark, rev=revs)).collect()}
    assert m[(2024, 1)] == Decimal("1") and m[(2024, 2)] == Decimal("2")


def test_e7_outside_the_grid(spark):
    revs = [with_(REV_A, revenue_id="r1", event_time="2017-12-31T00:00:00"),
            with_(REV_A, revenue_id="r2", event_time="2025-01-01T00:00:00")]
    rows = customer_summary(feeds(spark, rev=revs)).collect()
    assert len(rows) == 84 and all(r.total_payment_amount == 0 for r in rows)


def test_e8_replayed_message(spark):
    df = feed_from_rows(spark, schemas.REVENUE, [REV_A, REV_A])
    assert df.count() == 2
    assert dedup.dedup_by_key(df, ["revenue_id"]).count() == 1


def _decode(spark, texts):
    raw = spark.createDataFrame([(t,) for t in texts], "value string")
    return json_events.split_valid(json_events.decode_events(raw, schemas.SUBSCRIPTION), schemas.SUBSCRIPTION)


def test_e9_bad_messages_rejected(spark):
    good = json_events.encode_events(feed_from_rows(spark, schemas.SUBSCRIPTION, [SUB_A]),
                                     schemas.SUBSCRIPTION).first().value
    texts = [
        good,
        good[:-7],                                                   # broken JSON
        good.replace('"user_id":"user-123",', ""),                   # REQUIRED missing
        good.replace('"subscription_amount":2000.000000000', '"subscription_amount":"abc"'),
        good.replace('"contract_length_months":12', '"contract_length_months":12.0'),
    ]
    valid, rejects = _decode(spark, texts)
    assert valid.count() == 1
    reasons = sorted(r.reason for r in rejects.collect())
    assert reasons == ["malformed", "malformed", "malformed", "missing:user_id"]


def test_e10_timestamp_forms(spark):
    good = json_events.encode_events(feed_from_rows(spark, schemas.SUBSCRIPTION, [SUB_A]),
                                     schemas.SUBSCRIPTION).first().value
    assert '"event_time":"2024-01-15T00:00:00 UTC"' in good
    texts = [good.replace("2024-01-15T00:00:00 UTC", form)
             for form in ("2024-01-15T00:00:00 UTC", "2024-01-15T00:00:00", "2024-01-15T00:00:00.000000")]
    valid, rejects = _decode(spark, texts)
    assert rejects.count() == 0
    assert {r.event_time for r in valid.collect()} == {dt.datetime(2024, 1, 15)}
    texts = [good.replace("2024-01-15T00:00:00 UTC", form) for form in ("12:30:00", "T10:00", "2024", "2024-01", "2024-01-15", "")]
    valid, rejects = _decode(spark, texts)
    assert valid.count() == 0 and {r.reason for r in rejects.collect()} == {"bad_timestamp:event_time"}


def test_e8_rows_of_one_id_that_differ_keep_the_least(spark):
    rows = [with_(REV_A, payment_amount=x) for x in (7.0, 5.0, 9.0)]
    for order in (rows, rows[::-1]):
        assert dedup.dedup_by_key(feed_from_rows(spark, schemas.REVENUE, order), ["revenue_id"]).first().payment_amount == 5


def test_e11_null_status(spark):
    f = feeds(spark, [SUB_A], [with_(REV_A, repayment_status=None)])
    m2 = subscription_revenue_summary(f)
    assert audits.violations(m2, "allowed_value_checks").count() == 0
    assert audits.violations(m2, "rev_not_null_check").count() == 1


def test_e12_each_violation_hits_its_own_audit(spark):
    f = feeds(spark, [with_(SUB_A, annualized_revenue=0)],
              [with_(REV_A, repayment_status="paused", payment_delinquency="no_delinquency")],
              [with_(CHURN_A, churn_risk=1.2)], [with_(ENG_A, engagement_score=101)])
    m1 = customer_summary(f).where((F.col("year") == 2024) & (F.col("month") == 1))
    counts = audits.audit_counts(m1, audits.CUSTOMER_AUDITS).first().asDict()
    assert counts == {"aggregated_revenue_positive_customer_summary": 1, "key_dimensions_not_null": 0,
                      "allowed_repayment_and_trend": 1, "churn_risk_within_range": 1,
                      "engagement_score_range": 1}
    m2 = subscription_revenue_summary(f)
    counts = audits.audit_counts(m2, audits.REVENUE_AUDITS).first().asDict()
    assert counts == {"rev_not_null_check": 0, "aggregated_revenue_positive_rev_summary": 1,
                      "allowed_value_checks": 1, "repayment_delinquency_consistency": 0}


def test_e13_cancellation_reason_states(spark):
    churn = [with_(CHURN_A, churn_event_id="c1", user_id="u1", cancellation_reason="none"),
             with_(CHURN_A, churn_event_id="c2", user_id="u2", cancellation_reason=None),
             with_(CHURN_A, churn_event_id="c3", user_id="u3", cancellation_reason="pricing")]
    rows = customer_summary(feeds(spark, churn=churn)).where("year = 2024 AND month = 1").collect()
    assert {r.user_id: r.cancellation_reason for r in rows} == {"u1": "none", "u2": "N/A", "u3": "pricing"}


def test_e14_empty_feed(spark):
    f = feeds(spark, [SUB_A])
    assert customer_summary(f).count() == 84
    assert customer_summary(feeds(spark)).count() == 0
    assert subscription_revenue_summary(f).count() == 0


def test_absent_events_stand_beside_all_others(spark):
    """Dropping absent events loses none that is there, whatever its line number."""
    revs = [with_(REV_A, revenue_id=f"7-{line}-1-1") for line in range(1, 10)] + [with_(REV_A, revenue_id="lone")]
    rows = faults.some_absent(feeds(spark, [SUB_A], revs)["revenue"]).collect()
    assert sum(r.event is None for r in rows) == 2
    assert sorted(r.event.revenue_id for r in rows if r.event) == sorted(r["revenue_id"] for r in revs)


def test_derived_revenue_has_every_event(spark, tmp_path):
    orders = spark.createDataFrame([(1, 5), (2, 6)], "o_orderkey long, o_custkey long")
    lines = spark.sql("""SELECT o AS l_orderkey, o AS l_partkey, o AS l_suppkey, CAST(n AS int) AS l_linenumber, 1.0D AS l_quantity,
        10.0D AS l_extendedprice, 0.1D AS l_discount, 0.02D AS l_tax, 'R' AS l_returnflag, 'F' AS l_linestatus,
        TIMESTAMP '1998-06-01' AS l_shipdate FROM (SELECT explode(array(1L, 2L)) AS o), (SELECT explode(sequence(1, 9)) AS n)""")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    ids = [r.revenue_id for r in QUERIES["derived_revenue"](spark, str(tmp_path)).collect()]
    assert sorted(ids) == sorted(f"{o}-{n}-{o}-{o}" for o in (1, 2) for n in range(1, 10))


def test_time_texts_are_matched_once(spark):
    """Filters on decoded times don't match and cast their texts again."""
    raw = spark.createDataFrame([("{}",)], "value string")
    valid, rejects = json_events.split_valid(json_events.decode_events(raw, schemas.REVENUE), schemas.REVENUE)
    for rows in (valid, rejects):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert plan.count("RLIKE(") == plan.count("try_cast(") == 2  # event_time and due_date


def test_wire_text_of_fractions(spark):
    """A fraction is written only where there is one, before 1970 as well."""
    times = ["2024-01-01 00:00:00", "2024-01-01 00:00:00.5", "1969-12-31 23:59:59.999999", "1960-01-01 00:00:00", None]
    got = spark.createDataFrame([(t,) for t in times], "t string").select(timefns.to_wire_text(F.col("t").cast("timestamp")))
    assert [r[0] for r in got.collect()] == ["2024-01-01T00:00:00 UTC", "2024-01-01T00:00:00.500000 UTC", "1969-12-31T23:59:59.999999 UTC", "1960-01-01T00:00:00 UTC", None]
