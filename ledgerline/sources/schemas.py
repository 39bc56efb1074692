"""Typed schemas of the four raw event tables.

NUMERIC maps to decimal(38,9), INTEGER to bigint, TIMESTAMP to a UTC
timestamp. Spark turns ``nullable=False`` into nullable on file reads, so the
REQUIRED columns are also listed in ``REQUIRED`` and enforced by a filter at
ingest (see ``sources.json_events.split_valid``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

NUMERIC = T.DecimalType(38, 9)
INTEGER = T.LongType()
STRING = T.StringType()
TIMESTAMP = T.TimestampType()
BOOLEAN = T.BooleanType()


@dataclass(frozen=True)
class Feed:
    name: str          # logical feed name used across the package
    topic: str         # source topic
    table: str         # raw table written by ingest
    pk: str            # event id column
    fields: tuple      # (column, type, required)

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, t, not req) for c, t, req in self.fields])

    @property
    def required(self) -> list[str]:
        return [c for c, _, req in self.fields if req]

    @property
    def columns(self) -> list[str]:
        return [c for c, _, _ in self.fields]


# Topic names, raw table names, column names, types and modes of
# the four feeds, as declared by the source pipeline.
SUBSCRIPTION = Feed(
    "subscription", "subscriptions", "raw_subscription_events", "subscription_id",
    (
        ("subscription_id", STRING, True),
        ("user_id", STRING, True),
        ("event_time", TIMESTAMP, True),
        ("subscription_amount", NUMERIC, True),
        ("event_type", STRING, True),
        ("subscription_plan", STRING, True),
        ("region", STRING, True),
        ("user_segment", STRING, True),
        ("contract_length_months", INTEGER, True),
        ("capital_eligibility", BOOLEAN, True),
        ("growth_rate", NUMERIC, True),
        ("annualized_revenue", NUMERIC, True),
        ("billing_connection_status", BOOLEAN, True),
        ("customer_growth_rate", NUMERIC, True),
        ("bank_connection_quality", INTEGER, True),
    ),
)

REVENUE = Feed(
    "revenue", "revenue", "raw_revenue_events", "revenue_id",
    (
        ("revenue_id", STRING, True),
        ("user_id", STRING, True),
        ("event_time", TIMESTAMP, True),
        ("payment_amount", NUMERIC, True),
        ("payment_method", STRING, True),
        ("discount_applied", NUMERIC, True),
        ("currency", STRING, True),
        ("invoice_id", STRING, True),
        ("recurring_period", STRING, True),
        ("due_date", TIMESTAMP, True),
        ("capital_utilization", BOOLEAN, True),
        ("revenue_stability_score", INTEGER, True),
        ("advance_amount", NUMERIC, True),
        ("repayment_percentage", NUMERIC, True),
        ("repayment_status", STRING, True),
        ("revenue_trend", STRING, True),
        ("revenue_volatility", NUMERIC, True),
        ("capital_offer_accepted", BOOLEAN, True),
        ("payment_delinquency", STRING, True),
    ),
)

CHURN = Feed(
    "churn", "churn", "raw_churn_events", "churn_event_id",
    (
        ("churn_event_id", STRING, True),
        ("user_id", STRING, True),
        ("event_time", TIMESTAMP, True),
        ("churn_risk", NUMERIC, True),
        ("customer_tenure_days", INTEGER, True),
        ("last_activity_gap_days", INTEGER, True),
        ("support_ticket_count", INTEGER, True),
        ("usage_drop_percentage", NUMERIC, True),
        ("satisfaction_score", INTEGER, True),
        ("recent_capital_offer", BOOLEAN, True),
        ("cancellation_reason", STRING, False),
        ("capital_withdrawal_flag", BOOLEAN, False),
    ),
)

ENGAGEMENT = Feed(
    "engagement", "customer_engagement", "raw_customer_engagement_events", "engagement_id",
    (
        ("engagement_id", STRING, True),
        ("user_id", STRING, True),
        ("event_time", TIMESTAMP, True),
        ("engagement_score", INTEGER, True),
        ("session_duration", NUMERIC, True),
        ("login_count", INTEGER, True),
        ("dashboard_views", INTEGER, True),
        ("financing_inquiries", INTEGER, True),
        ("feature_interaction_count", INTEGER, True),
        ("api_request_count", INTEGER, True),
        ("referral_count", INTEGER, True),
        ("capital_access_count", INTEGER, True),
        ("report_download_count", INTEGER, True),
        ("integration_usage", INTEGER, True),
        ("financing_conversion_rate", NUMERIC, True),
        ("platform_dependency_score", INTEGER, True),
        ("connected_account_status", BOOLEAN, True),
        ("revenue_insights_views", INTEGER, True),
    ),
)

FEEDS: dict[str, Feed] = {f.name: f for f in (SUBSCRIPTION, REVENUE, CHURN, ENGAGEMENT)}
