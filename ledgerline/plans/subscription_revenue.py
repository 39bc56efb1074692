"""Model ``subscription_revenue_summary``: one row per (user, revenue day)
in months that have both a subscription and revenue.

As written, the model joins per-timestamp subscription and revenue roll-ups
on (user, month, year) and regroups by revenue day, taking ANY_VALUE of each
side. With the package's pick rule (earliest row wins) the subscription
values of a day are those of the month's earliest subscription timestamp and
the revenue values are those of the day's earliest revenue timestamp. So each
side is reduced first - subscriptions to one row per month, revenue to one
row per day - and the join becomes one-to-many on a unique month key: no
subscription x revenue pair product is ever formed, however many events a
user has in a month.

Consequences kept from the model: payments at different times of one day
are not summed (the earliest timestamp's totals win), and months with only
one side are dropped by the inner join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerline.functions.picks import pick_struct, unpack
from ledgerline.functions.timefns import day_of, month_year
from ledgerline.operators import rollups

SUB_VALUES = ["subscription_plan", "region", "user_segment", "avg_growth_rate",
              "total_annualized_revenue", "avg_customer_growth_rate"]
REV_VALUES = ["total_payment_amount", "avg_revenue_stability_score", "total_advance_amount",
              "repayment_status", "revenue_trend", "avg_revenue_volatility", "payment_delinquency",
              "capital_utilization", "capital_offer_accepted"]
OUTPUT_ORDER = ["user_id", "event_date", "year", "month", "month_year", *SUB_VALUES, *REV_VALUES]


def subscription_revenue_summary(feeds: dict[str, DataFrame]) -> DataFrame:
    # One shuffle a feed: both levels and the join keep this distribution. A user's months are
    # dealt apart, so a hot user is spread over as many tasks as it has months.
    dealt = {name: rollups.dealt_by_month(feeds[name]) for name in ("subscription", "revenue")}
    sub_ts = rollups.sub_by_timestamp(dealt["subscription"])
    rev_ts = rollups.rev_by_day_and_timestamp(dealt["revenue"])

    return summary_of_times(sub_ts, rev_ts)


def summary_of_buckets(feeds: dict[str, DataFrame]) -> DataFrame:
    """The model from feeds stored in buckets (``sources.bucketed``): no shuffle at all, from scan to join."""
    return summary_of_times(rollups.sub_by_timestamp(feeds["subscription"]), rollups.rev_by_day_and_timestamp(feeds["revenue"]))


def summary_of_times(sub_ts: DataFrame, rev_ts: DataFrame) -> DataFrame:
    """The model from per-timestamp roll-ups; of a month's subscription and a day's revenue timestamps the earliest counts."""
    sub_month = (
        sub_ts.groupBy("user_id", "year", "month")
        .agg(pick_struct(SUB_VALUES, ["event_time"]).alias("_s"))
        .select("user_id", "year", "month", *unpack("_s", SUB_VALUES))
    )
    rev_day = (
        (rev_ts if "event_date" in rev_ts.columns else rev_ts.withColumn("event_date", day_of("event_time")))
        .groupBy("user_id", "year", "month", "event_date")
        .agg(pick_struct(REV_VALUES, ["event_time"]).alias("_r"))
        .select(
            "user_id", "event_date", "year", "month",
            month_year("event_date").alias("month_year"),
            *unpack("_r", REV_VALUES),
        )
    )
    return rev_day.join(sub_month, ["user_id", "year", "month"], "inner").select(*OUTPUT_ORDER)
