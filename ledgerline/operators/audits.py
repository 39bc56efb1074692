"""Data-quality audits: each returns the rows of a model that break a rule.

An audit passes when it returns no rows. ``violations(model, audit)`` is the
audit itself (the model under audit is simply the argument);
``audit_counts(model, audits)`` evaluates every predicate of a model in a
single scan and returns one row of counts.

Predicates follow SQL WHERE semantics: a NULL predicate does not select the
row (so ``status NOT IN (...)`` does not flag a NULL status - the NOT NULL
audit does).

The customer summary fills months without events with 0 and 'N/A', which the
literal revenue and allowed-value rules flag. ``skip_gaps`` variants apply
the rule only to months that had events of the feed in question.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Allowed value sets checked by the audits.
REPAYMENT_STATUSES = ("on_track", "delayed", "completed")
REVENUE_TRENDS = ("stable", "increasing", "declining")
DELINQUENCIES = ("no_delinquency", "no_payment", "payment_failure")
DELAYED_DELINQUENCIES = ("no_payment", "payment_failure")
GAP_FILL = "N/A"


@dataclass(frozen=True)
class Audit:
    name: str
    model: str
    predicate: Callable[[], Column]
    description: str


def any_null(columns) -> Column:
    return reduce(or_, [F.col(c).isNull() for c in columns])


def non_positive(columns) -> Column:
    return reduce(or_, [F.col(c) <= 0 for c in columns])


def not_in(column: str, allowed) -> Column:
    return ~F.col(column).isin(*allowed)


def out_of_range(column: str, lo, hi) -> Column:
    return (F.col(column) < lo) | (F.col(column) > hi)


def _delinquency_mismatch() -> Column:
    status, delinq = F.col("repayment_status"), F.col("payment_delinquency")
    return (((status == "delayed") & ~delinq.isin(*DELAYED_DELINQUENCIES))
            | ((status != "delayed") & (delinq != "no_delinquency")))


def _present(column: str) -> Column:
    return F.col(column) != GAP_FILL


CUSTOMER_AUDITS = [
    Audit("aggregated_revenue_positive_customer_summary", "customer_summary",
          lambda: non_positive(["total_payment_amount", "total_annualized_revenue"]),
          "payment or annualized revenue <= 0"),
    Audit("key_dimensions_not_null", "customer_summary",
          lambda: any_null(["user_id", "month", "year"]),
          "user_id, month or year is NULL"),
    Audit("allowed_repayment_and_trend", "customer_summary",
          lambda: (not_in("repayment_status", REPAYMENT_STATUSES)
                   | not_in("revenue_trend", REVENUE_TRENDS)
                   | not_in("payment_delinquency", DELINQUENCIES)),
          "status, trend or delinquency outside its set"),
    Audit("churn_risk_within_range", "customer_summary",
          lambda: out_of_range("avg_churn_risk", 0, 1), "avg_churn_risk outside [0, 1]"),
    Audit("engagement_score_range", "customer_summary",
          lambda: out_of_range("avg_engagement_score", 0, 100),
          "avg_engagement_score outside [0, 100]"),
]

# Same rules restricted to months that had events of the feed in question.
CUSTOMER_GAP_AWARE_AUDITS = [
    Audit("aggregated_revenue_positive_customer_summary_skip_gaps", "customer_summary",
          lambda: ((_present("repayment_status") & (F.col("total_payment_amount") <= 0))
                   | (_present("subscription_plan") & (F.col("total_annualized_revenue") <= 0))),
          "as above, only for months with revenue / subscription events"),
    Audit("allowed_repayment_and_trend_skip_gaps", "customer_summary",
          lambda: _present("repayment_status") & (
              not_in("repayment_status", REPAYMENT_STATUSES)
              | not_in("revenue_trend", REVENUE_TRENDS)
              | not_in("payment_delinquency", DELINQUENCIES)),
          "as above, only for months with revenue events"),
]

REVENUE_AUDITS = [
    Audit("rev_not_null_check", "subscription_revenue_summary",
          lambda: any_null(["user_id", "month", "year", "total_annualized_revenue",
                            "total_payment_amount", "avg_revenue_stability_score",
                            "total_advance_amount", "repayment_status", "revenue_trend",
                            "avg_revenue_volatility", "payment_delinquency"]),
          "any of 11 columns is NULL"),
    Audit("aggregated_revenue_positive_rev_summary", "subscription_revenue_summary",
          lambda: F.col("total_annualized_revenue") <= 0, "annualized revenue <= 0"),
    Audit("allowed_value_checks", "subscription_revenue_summary",
          lambda: not_in("repayment_status", REPAYMENT_STATUSES) | not_in("revenue_trend", REVENUE_TRENDS),
          "status or trend outside its set"),
    Audit("repayment_delinquency_consistency", "subscription_revenue_summary",
          _delinquency_mismatch, "status and delinquency disagree"),
]

AUDITS: dict[str, Audit] = {
    a.name: a for a in CUSTOMER_AUDITS + CUSTOMER_GAP_AWARE_AUDITS + REVENUE_AUDITS}

def violations(model: DataFrame, audit: Audit | str) -> DataFrame:
    """Rows of ``model`` that break the audit (empty when it passes)."""
    a = AUDITS[audit] if isinstance(audit, str) else audit
    return model.where(a.predicate())


def count_columns(audits) -> list[Column]:
    """One bigint aggregate per audit: number of violating rows."""
    return [F.coalesce(F.sum(F.when(a.predicate(), F.lit(1)).otherwise(F.lit(0))), F.lit(0)).cast("bigint").alias(a.name)
            for a in audits]


def audit_counts(model: DataFrame, audits) -> DataFrame:
    """One row, one bigint column per audit: number of violating rows (single scan)."""
    return model.agg(*count_columns(audits))
