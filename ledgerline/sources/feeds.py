"""The four raw event feeds, derived from the driver's TPC-H-like tables.

The driver's data has no subscription feeds, so each feed is a typed
projection of existing tables (whole tables, no sampling):

* subscription  = orders x customer x (nation x region)
* revenue       = lineitem x orders
* churn         = events with event_type 'error'
* engagement    = events of every other type

Columns the tables do not carry are derived by fixed rules from keys and
values (for example plan from order priority, repayment status from the
return flag), using the same rules the event producer applies (see
``functions.derive``). Every output column has exactly the feed's declared
type (``sources.schemas``).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import derive
from ledgerline.sources import schemas
from ledgerline.sources.tables import read_table

# What the feeds' text columns may hold.
PAYMENT_METHODS = ["credit_card", "paypal", "bank_transfer"]
CURRENCIES = ["USD", "EUR", "GBP"]
PERIODS = ["monthly", "quarterly", "annual"]
PLANS = ["basic", "pro", "enterprise"]
CHURN_REASONS = ["pricing", "lack_of_feature", "competitor", "other"]


def _pick(values: list[str], index: Column) -> Column:
    """values[index] with a 0-based index."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _d(x: str) -> Column:
    return F.lit(Decimal(x))


def _finish(df: DataFrame, feed: schemas.Feed) -> DataFrame:
    """Exactly the feed's columns and types (one projection)."""
    return df.selectExpr(*[f"CAST(`{c}` AS {t.simpleString()}) AS `{c}`" for c, t, _ in feed.fields])


def subscription_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "r_name")
    cust = c.join(geo, c.c_nationkey == geo.n_nationkey).select(
        "c_custkey", "c_mktsegment", "c_acctbal", "r_name")
    j = o.join(cust, o.o_custkey == cust.c_custkey)

    amount = F.col("o_totalprice").cast("decimal(18,2)")
    annualized = derive.annualize(amount)
    out = j.select(
        F.col("o_orderkey").cast("string").alias("subscription_id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("o_orderdate").cast("timestamp").alias("event_time"),
        amount.alias("subscription_amount"),
        F.when(F.col("o_orderstatus") == "O", F.lit("new_subscription"))
        .when(F.col("o_orderstatus") == "F", F.lit("renewal"))
        .otherwise(F.lit("cancellation")).alias("event_type"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("enterprise"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.lit("pro"))
        .otherwise(F.lit("basic")).alias("subscription_plan"),
        F.col("r_name").alias("region"),
        F.col("c_mktsegment").alias("user_segment"),
        ((F.col("o_orderkey") % 5 + 1) * 12).alias("contract_length_months"),
        (F.col("c_acctbal") > 0).alias("capital_eligibility"),
        ((F.col("o_orderkey") % 2001 - 1000).cast("decimal(18,0)") * _d("0.001")).alias("growth_rate"),
        annualized.alias("annualized_revenue"),
        (F.col("o_orderstatus") == "F").alias("billing_connection_status"),
        ((F.col("o_orderkey") % 10007 - 5003).cast("decimal(18,0)") * _d("0.00012345")).alias("customer_growth_rate"),
        (F.col("o_orderkey") % 100 + 1).alias("bank_connection_quality"),
    )
    return _finish(out, schemas.SUBSCRIPTION)


def revenue_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey)

    price = F.col("l_extendedprice").cast("decimal(18,2)")
    disc = F.col("l_discount").cast("decimal(18,2)")
    tax = F.col("l_tax").cast("decimal(18,2)")
    status = (
        F.when(F.col("l_returnflag") == "N", F.lit("on_track"))
        .when(F.col("l_returnflag") == "R", F.lit("delayed"))
        .when(F.col("l_returnflag") == "A", F.lit("completed"))
    )
    delinquency = derive.delinquency(status, F.col("l_linestatus") == "F")
    trend = (
        F.when(F.col("l_quantity") < 17, F.lit("declining"))
        .when(F.col("l_quantity") < 34, F.lit("stable"))
        .otherwise(F.lit("increasing"))
    )

    event_time = F.col("l_shipdate").cast("timestamp")
    out = j.select(
        F.concat_ws("-", *[F.col(c).cast("string") for c in
                           ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]).alias("revenue_id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        event_time.alias("event_time"),
        price.alias("payment_amount"),
        _pick(PAYMENT_METHODS, F.col("l_linenumber") % 3).alias("payment_method"),
        (disc * 100).alias("discount_applied"),
        _pick(CURRENCIES, F.col("l_suppkey") % 3).alias("currency"),
        F.concat(F.lit("inv-"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("invoice_id"),
        _pick(PERIODS, F.col("l_partkey") % 3).alias("recurring_period"),
        derive.due_date(event_time).alias("due_date"),
        (F.col("l_linestatus") == "O").alias("capital_utilization"),
        F.col("l_quantity").cast("bigint").alias("revenue_stability_score"),
        (price * (F.lit(1) - disc)).alias("advance_amount"),
        (F.lit(3) + tax * 100).alias("repayment_percentage"),
        status.alias("repayment_status"),
        trend.alias("revenue_trend"),
        disc.alias("revenue_volatility"),
        (F.col("l_tax") >= 0.04).alias("capital_offer_accepted"),
        delinquency.alias("payment_delinquency"),
    )
    return _finish(out, schemas.REVENUE)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props")
    return e.withColumn(
        "k", F.coalesce(F.get_json_object("props", "$.k").cast("bigint"), F.lit(0).cast("bigint")))


def churn_base(event_id: Column) -> Column:
    """A risk to start from, from the event's number, in steps of a thousandth."""
    return (event_id % 1000).cast("decimal(18,0)") * _d("0.001")


def churn_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir).where(F.col("event_type") == "error")
    val = F.col("value").cast("decimal(18,2)")
    tickets = F.col("k") % 9
    drop = derive.clip(val, _d("0"), _d("100"))
    satisfaction = F.col("k") % 10 + 1
    base = churn_base(F.col("event_id"))
    raw = derive.churn_risk_raw(base, tickets, drop, satisfaction)
    risk = derive.churn_score(base, tickets, drop, satisfaction)
    reason = F.when(F.col("k") % 7 == 0, F.lit(None).cast("string")).otherwise(
        derive.high_risk_default(
            raw, _pick(CHURN_REASONS, F.col("event_id") % 4), F.lit("none")))
    flag = F.when(F.col("k") % 11 == 0, F.lit(None).cast("boolean")).otherwise(
        derive.high_risk_default(raw, F.col("event_id") % 2 == 1, F.lit(False)))
    out = e.select(
        F.col("event_id").cast("string").alias("churn_event_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("ts").cast("timestamp").alias("event_time"),
        risk.alias("churn_risk"),
        (F.col("user_id") % 2000).alias("customer_tenure_days"),
        (F.col("event_id") % 90).alias("last_activity_gap_days"),
        tickets.alias("support_ticket_count"),
        drop.alias("usage_drop_percentage"),
        satisfaction.alias("satisfaction_score"),
        (F.col("event_id") % 2 == 0).alias("recent_capital_offer"),
        reason.alias("cancellation_reason"),
        flag.alias("capital_withdrawal_flag"),
    )
    return _finish(out, schemas.CHURN)


def engagement_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir).where(F.col("event_type") != "error")
    val = F.col("value").cast("decimal(18,2)")
    k = F.col("k")
    score = F.round(derive.clip(val, _d("1"), _d("100")), 0)
    inquiries = k % 4
    connected = k % 2 == 0
    etype = F.col("event_type")
    out = e.select(
        F.col("event_id").cast("string").alias("engagement_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("ts").cast("timestamp").alias("event_time"),
        score.alias("engagement_score"),
        val.alias("session_duration"),
        F.when(etype == "view", k % 5 + 1).otherwise(F.lit(0)).alias("login_count"),
        (k % 8).alias("dashboard_views"),
        inquiries.alias("financing_inquiries"),
        F.when(etype == "click", k % 3 + 1).otherwise(F.lit(0)).alias("feature_interaction_count"),
        k.alias("api_request_count"),
        F.when(etype == "signup", F.lit(1)).otherwise(F.lit(0)).alias("referral_count"),
        F.when(etype == "purchase", F.lit(1)).otherwise(F.lit(0)).alias("capital_access_count"),
        (k % 3).alias("report_download_count"),
        (k % 5).alias("integration_usage"),
        derive.guarded_rate(inquiries, (k % 100).cast("decimal(18,0)") * _d("0.01"))
        .alias("financing_conversion_rate"),
        (k % 100 + 1).alias("platform_dependency_score"),
        connected.alias("connected_account_status"),
        F.when(connected, k).otherwise(F.floor(k / 10)).alias("revenue_insights_views"),
    )
    return _finish(out, schemas.ENGAGEMENT)


FEED_BUILDERS = {
    "subscription": subscription_feed,
    "revenue": revenue_feed,
    "churn": churn_feed,
    "engagement": engagement_feed,
}


def load_feeds(spark: SparkSession, sf_dir: str, names=None) -> dict[str, DataFrame]:
    """The feeds (all four, or ``names``) as lazily evaluated DataFrames."""
    return {name: build(spark, sf_dir)
            for name, build in FEED_BUILDERS.items() if names is None or name in names}


def user_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-user profile: region, segment and default plan (one row per customer)."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "r_name")
    return c.join(geo, c.c_nationkey == geo.n_nationkey).select(
        F.col("c_custkey").cast("string").alias("user_id"),
        F.col("r_name").alias("region"),
        F.col("c_mktsegment").alias("user_segment"),
        _pick(PLANS, F.col("c_custkey") % 3).alias("default_plan"),
    )
