"""Per-feed roll-ups.

Monthly roll-ups (one row per user, year, month) feed the customer summary;
per-timestamp roll-ups (one row per user, exact event time) feed the
subscription/revenue summary. Year and month depend only on the timestamp,
so they are derived before grouping and need no extra work. The per-timestamp
roll-ups group by them too, though the timestamp decides them, so that rows
already dealt by (user, year, month) need no further shuffle.

Every aggregate here is partially aggregated in each task before the shuffle,
so a user holding a large share of the rows sends at most one partial row
per task and group, not its raw events.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.picks import decimal_mean, integer_mean, pick_struct, unpack
from ledgerline.functions.timefns import day_of, month_of, year_of

MONTH_KEYS = ["user_id", "year", "month"]

SUB_PICKS = ["subscription_plan", "region", "user_segment"]
REV_PICKS = ["repayment_status", "revenue_trend", "payment_delinquency"]
CHURN_PICKS = ["cancellation_reason", "capital_withdrawal_flag"]
REV_TS_PICKS = ["capital_utilization", "repayment_status", "revenue_trend",
                "payment_delinquency", "capital_offer_accepted"]


def with_month(df: DataFrame, ts: str = "event_time") -> DataFrame:
    """df with the year and month of its timestamp; columns of these names are kept, so that rows dealt by them stay dealt."""
    if {"year", "month"} <= set(df.columns):
        return df
    return df.withColumn("year", year_of(ts)).withColumn("month", month_of(ts))


def dealt_by_month(df: DataFrame, tasks: int | None = None) -> DataFrame:
    """df dealt by user, year and month (to as many tasks as adaptive execution finds, or ``tasks``); year and month are not dealt
    with the rows, ``with_month`` makes them of the time again."""
    by = "user_id", year_of("event_time"), month_of("event_time")
    return df.repartition(*by) if tasks is None else df.repartition(tasks, *by)


# Measures per feed, shared by the monthly and per-timestamp roll-ups, by the stacked
# customer summary (where other feeds' rows are NULL and ignored) and by the mergeable
# partials: (aggregate, input, output).
MEASURES = {
    "subscription": [
        ("decimal_mean", "growth_rate", "avg_growth_rate"),
        ("sum", "annualized_revenue", "total_annualized_revenue"),
        ("decimal_mean", "customer_growth_rate", "avg_customer_growth_rate"),
    ],
    "revenue": [
        ("sum", "payment_amount", "total_payment_amount"),
        ("integer_mean", "revenue_stability_score", "avg_revenue_stability_score"),
        ("sum", "advance_amount", "total_advance_amount"),
        ("decimal_mean", "revenue_volatility", "avg_revenue_volatility"),
    ],
    "churn": [
        ("decimal_mean", "churn_risk", "avg_churn_risk"),
        ("integer_mean", "customer_tenure_days", "avg_customer_tenure"),
        ("integer_mean", "last_activity_gap_days", "avg_last_activity_gap"),
        ("sum", "support_ticket_count", "total_support_ticket_count"),
        ("decimal_mean", "usage_drop_percentage", "avg_usage_drop_percentage"),
        ("integer_mean", "satisfaction_score", "avg_satisfaction_score"),
    ],
    "engagement": [
        ("integer_mean", "engagement_score", "avg_engagement_score"),
        ("decimal_mean", "session_duration", "avg_session_duration"),
        ("sum", "login_count", "total_login_count"),
        ("sum", "financing_inquiries", "total_financing_inquiries"),
        ("sum", "feature_interaction_count", "total_feature_interaction_count"),
        ("sum", "capital_access_count", "total_capital_access_count"),
    ],
}
AGGREGATES = {"sum": F.sum, "decimal_mean": decimal_mean, "integer_mean": integer_mean}


def measures(feed: str) -> list:
    return [AGGREGATES[kind](column).alias(out) for kind, column, out in MEASURES[feed]]


def sub_measures() -> list:
    return measures("subscription")


def rev_measures() -> list:
    return measures("revenue")


def churn_measures() -> list:
    return measures("churn")


def engage_measures() -> list:
    return measures("engagement")


SUB_COLUMNS = SUB_PICKS + ["avg_growth_rate", "total_annualized_revenue", "avg_customer_growth_rate"]
REV_COLUMNS = ["total_payment_amount", "avg_revenue_stability_score", "total_advance_amount",
               "repayment_status", "revenue_trend", "avg_revenue_volatility", "payment_delinquency"]
CHURN_COLUMNS = ["avg_churn_risk", "avg_customer_tenure", "avg_last_activity_gap",
                 "total_support_ticket_count", "avg_usage_drop_percentage", "avg_satisfaction_score",
                 "cancellation_reason", "capital_withdrawal_flag"]
ENGAGE_COLUMNS = ["avg_engagement_score", "avg_session_duration", "total_login_count",
                  "total_financing_inquiries", "total_feature_interaction_count",
                  "total_capital_access_count"]


def _monthly(df: DataFrame, picks: list[str], pk: str, measures: list, columns: list[str], more: dict[str, Column]) -> DataFrame:
    aggs = [*measures, *[a.alias(name) for name, a in more.items()]]
    if picks:
        aggs.insert(0, pick_struct(picks, ["event_time", pk]).alias("_pick"))
    out = with_month(df).groupBy(*MONTH_KEYS).agg(*aggs)
    cols = [F.col(f"_pick.{c}").alias(c) if c in picks else F.col(c) for c in columns]
    return out.select("user_id", "month", "year", *cols, *more)


def agg_sub(sub: DataFrame, **more: Column) -> DataFrame:
    """Monthly subscription roll-up: 3 picks, 2 means, 1 sum. ``more``: further aggregates by name, as in the others."""
    return _monthly(sub, SUB_PICKS, "subscription_id", sub_measures(), SUB_COLUMNS, more)


def agg_rev(rev: DataFrame, **more: Column) -> DataFrame:
    """Monthly revenue roll-up: 2 sums, 2 means, 3 picks."""
    return _monthly(rev, REV_PICKS, "revenue_id", rev_measures(), REV_COLUMNS, more)


def agg_churn(churn: DataFrame, **more: Column) -> DataFrame:
    """Monthly churn roll-up: 5 means, 1 sum, 2 picks."""
    return _monthly(churn, CHURN_PICKS, "churn_event_id", churn_measures(), CHURN_COLUMNS, more)


def agg_engage(eng: DataFrame, **more: Column) -> DataFrame:
    """Monthly engagement roll-up: 2 means, 4 sums (no picks: stays a hash aggregate)."""
    return _monthly(eng, [], "engagement_id", engage_measures(), ENGAGE_COLUMNS, more)


def side_by_side(parts: list[DataFrame], bits: list[str] = ()) -> DataFrame:
    """Monthly roll-ups, each unique on MONTH_KEYS, in one row a user and month that any of them has.

    They are put under each other, each in a column of its own, and grouped, so parts that are dealt alike stay where they are
    and others are dealt once (full joins would deal each result anew). ``bits``: columns of all parts that are or-ed together.
    """
    own = [[c for c in part.columns if c not in (*MONTH_KEYS, *bits)] for part in parts]
    kinds = [part.select(F.struct(*cols).alias("x")).schema["x"].dataType for part, cols in zip(parts, own)]
    under = [part.select(*MONTH_KEYS, *bits, *[(F.struct(*own[i]) if i == j else F.lit(None).cast(kind)).alias(f"_part{j}") for j, kind in enumerate(kinds)])
             for i, part in enumerate(parts)]
    # Of each part a group has one row at most, and max takes no NULL.
    rows = reduce(DataFrame.union, under).groupBy(*MONTH_KEYS).agg(
        *[F.max(f"_part{j}").alias(f"_part{j}") for j in range(len(parts))], *[F.bit_or(b).alias(b) for b in bits])
    return rows.select(*MONTH_KEYS, *[F.col(f"_part{j}.{c}").alias(c) for j, cols in enumerate(own) for c in cols], *bits)


def rev_by_timestamp(rev: DataFrame) -> DataFrame:
    """Revenue per (user, exact event time): 2 sums, 2 means, 5 picks from one row."""
    return rev_by_day_and_timestamp(rev).drop("event_date")


def rev_by_day_and_timestamp(rev: DataFrame) -> DataFrame:
    """The same with the day, by which rows are grouped too: they are in the order that a roll-up by day and a join by month need."""
    out = with_month(rev).groupBy(*MONTH_KEYS, day_of("event_time").alias("event_date"), "event_time").agg(
        pick_struct(REV_TS_PICKS, ["revenue_id"]).alias("_pick"), *rev_measures())
    return out.select(
        "event_date",
        "user_id", "event_time", "month", "year",
        "total_payment_amount", F.col("_pick.capital_utilization").alias("capital_utilization"),
        "avg_revenue_stability_score", "total_advance_amount",
        *[F.col(f"_pick.{c}").alias(c) for c in ("repayment_status", "revenue_trend")],
        "avg_revenue_volatility",
        *[F.col(f"_pick.{c}").alias(c) for c in ("payment_delinquency", "capital_offer_accepted")],
    )


def sub_by_timestamp(sub: DataFrame) -> DataFrame:
    """Subscriptions per (user, exact event time): 3 picks, 2 means, 1 sum."""
    out = with_month(sub).groupBy(*MONTH_KEYS, "event_time").agg(
        pick_struct(SUB_PICKS, ["subscription_id"]).alias("_pick"), *sub_measures())
    return out.select(
        "user_id", "event_time", "month", "year",
        *unpack("_pick", SUB_PICKS),
        "avg_growth_rate", "total_annualized_revenue", "avg_customer_growth_rate",
    )
