"""Faults put into feeds and messages by fixed rules: inputs of the queries that must find them.

``with_violations`` rewrites rows that the audits have to report; ``corrupt_by_rule``
damages messages that ingest has to reject; ``another_version`` is what a stored table may hold
before it is restated.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NUMERIC = "decimal(38,9)"


def _number(c: str) -> Column:
    return F.col(c).cast("bigint")


def _fixed(x: str) -> Column:
    return F.lit(Decimal(x)).cast(NUMERIC)


def violating_subscriptions(df: DataFrame) -> DataFrame:
    """Zero revenue, and events without a user."""
    key = _number("subscription_id")
    return df.withColumns({
        "annualized_revenue": F.when(key % 997 == 0, _fixed("0")).otherwise(F.col("annualized_revenue")),
        "user_id": F.when(key % 499 != 3, F.col("user_id")),
    })


def violating_revenue(df: DataFrame) -> DataFrame:
    """An unknown status, a missing trend, and delays without a delinquency."""
    line = F.split("revenue_id", "-")[1].cast("int")
    return df.withColumns({
        "payment_delinquency": F.when((line == 6) & (F.col("repayment_status") == "delayed"), "no_delinquency")
        .otherwise(F.col("payment_delinquency")),
        "repayment_status": F.when(line == 7, "paused").otherwise(F.col("repayment_status")),
        "revenue_trend": F.when(F.col("revenue_stability_score") != 50, F.col("revenue_trend")),
    })


def violating_churn(df: DataFrame) -> DataFrame:
    """A risk just over 1, which two places would hide."""
    return df.withColumn("churn_risk", F.when(_number("user_id") % 37 == 0, _fixed("1.004")).otherwise(F.col("churn_risk")))


def violating_engagement(df: DataFrame) -> DataFrame:
    return df.withColumn("engagement_score", F.when(_number("user_id") % 41 == 0, F.lit(101).cast("bigint")).otherwise(F.col("engagement_score")))


VIOLATIONS = {"subscription": violating_subscriptions, "revenue": violating_revenue,
              "churn": violating_churn, "engagement": violating_engagement}


def with_violations(feeds: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: VIOLATIONS[name](df) for name, df in feeds.items()}


def corrupt_by_rule(encoded: DataFrame, key: Column) -> DataFrame:
    """Damage a rule-chosen set of messages (by ``key % 997``).

    1 truncated text, 2 user_id removed, 3 an INTEGER written as 3.0, 4 a NUMERIC
    written as text, 5 an event time that is not a timestamp, 6 a time without a
    date, 7 a year alone, 8 no event id. Every other message is left as is.
    """
    r = key % 997
    v = F.col("value")
    time = lambda text: F.regexp_replace(v, r'"event_time":"[^"]*"', f'"event_time":"{text}"')
    return encoded.withColumn(
        "value",
        F.when(r == 1, F.expr("substring(value, 1, length(value) - 7)"))
        .when(r == 2, F.regexp_replace(v, r'"user_id":"[^"]*",', ""))
        .when(r == 3, F.regexp_replace(v, r'"contract_length_months":(\d+)', '"contract_length_months":$1.0'))
        .when(r == 4, F.regexp_replace(v, r'"subscription_amount":[0-9.]+', '"subscription_amount":"abc"'))
        .when(r == 5, time("not-a-time"))
        .when(r == 6, time("12:30:00"))
        .when(r == 7, time("2024"))
        .when(r == 8, F.regexp_replace(v, r'"subscription_id":"[^"]*",', ""))
        .otherwise(v),
    )


def another_version(feeds: dict[str, DataFrame], missing_month: str, stray_month: str) -> dict[str, DataFrame]:
    """The feeds as an older load may have had them: no events in one month ('yyyy-MM'), and that month's events in another."""
    out = {}
    for name, df in feeds.items():
        in_month = F.date_format("event_time", "yyyy-MM") == missing_month
        moved = F.to_timestamp(F.concat(F.lit(stray_month + "-"), F.date_format("event_time", "dd HH:mm:ss")))
        # One pass over a feed, which is a join of tables; an event without a time is in neither month nor any other.
        out[name] = df.where(F.col("event_time").isNotNull()).withColumn("event_time", F.when(in_month, moved).otherwise(F.col("event_time")))
    return out


def without_a_user(feeds: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The feeds before some users had joined: none whose number is divisible by 7."""
    return {name: df.where(_number("user_id") % 7 != 0) for name, df in feeds.items()}


def some_absent(df: DataFrame) -> DataFrame:
    """Revenue events as one column ``event``, each of them, with an absent (NULL) one behind every fifth line number."""
    line = F.get(F.split("revenue_id", "-"), F.lit(1)).try_cast("int")
    event = F.struct(*df.columns)
    return df.select(F.explode(F.when(line % 5 == 4, F.array(event, F.lit(None))).otherwise(F.array(event))).alias("event"))
