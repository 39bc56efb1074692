"""Corrected golden cases (see FIXTURES.md section 3; the row values are fixed) and row builders."""

from ledgerline.sources import schemas
from ledgerline.sources.inline import feed_from_rows

SUB_A = dict(subscription_id="sub-001", user_id="user-123", event_time="2024-01-15T00:00:00",
             subscription_amount=2000.0, event_type="new_subscription", subscription_plan="pro",
             region="North America", user_segment="SMB", contract_length_months=12,
             capital_eligibility=True, growth_rate=0.50, annualized_revenue=24000.0,
             billing_connection_status=True, customer_growth_rate=0.10, bank_connection_quality=85)
REV_A = dict(revenue_id="rev-001", user_id="user-123", event_time="2024-01-20T00:00:00",
             payment_amount=5000.0, payment_method="credit_card", discount_applied=0.0, currency="USD",
             invoice_id="inv-001", recurring_period="monthly", due_date="2024-02-20T00:00:00",
             capital_utilization=False, revenue_stability_score=90, advance_amount=10000.0,
             repayment_percentage=10.0, repayment_status="on_track", revenue_trend="stable",
             revenue_volatility=0.20, capital_offer_accepted=True, payment_delinquency="no_delinquency")
CHURN_A = dict(churn_event_id="churn-001", user_id="user-123", event_time="2024-01-25T00:00:00",
               churn_risk=0.30, customer_tenure_days=200, last_activity_gap_days=10,
               support_ticket_count=1, usage_drop_percentage=10.0, satisfaction_score=8,
               recent_capital_offer=False, cancellation_reason=None, capital_withdrawal_flag=None)
ENG_A = dict(engagement_id="eng-001", user_id="user-123", event_time="2024-01-18T00:00:00",
             engagement_score=75, session_duration=30.0, login_count=3, dashboard_views=5,
             financing_inquiries=1, feature_interaction_count=2, api_request_count=10, referral_count=1,
             capital_access_count=0, report_download_count=2, integration_usage=3,
             financing_conversion_rate=0.20, platform_dependency_score=70, connected_account_status=True,
             revenue_insights_views=4)

UID_B = "11111111-1111-1111-1111-111111111111"
SUB_B = dict(subscription_id="sub-b1", user_id=UID_B, event_time="2025-02-19T21:12:47.962045",
             subscription_amount=1200.00, event_type="new_subscription", subscription_plan="enterprise",
             region="North America", user_segment="Enterprise", contract_length_months=36,
             capital_eligibility=True, growth_rate=0.75, annualized_revenue=14400.00,
             billing_connection_status=True, customer_growth_rate=0.80, bank_connection_quality=90)
REV_B = dict(revenue_id="rev-b1", user_id=UID_B, event_time="2025-02-19T21:00:00.000000",
             payment_amount=1200.00, payment_method="credit_card", discount_applied=0.00, currency="USD",
             invoice_id="22222222-2222-2222-2222-222222222222", recurring_period="monthly",
             due_date="2025-03-19T21:00:00.000000", capital_utilization=False, revenue_stability_score=85,
             advance_amount=0.00, repayment_percentage=10.00, repayment_status="on_track",
             revenue_trend="stable", revenue_volatility=0.10, capital_offer_accepted=False,
             payment_delinquency="no_delinquency")


def feeds(spark, sub=(), rev=(), churn=(), eng=()):
    return {
        "subscription": feed_from_rows(spark, schemas.SUBSCRIPTION, list(sub)),
        "revenue": feed_from_rows(spark, schemas.REVENUE, list(rev)),
        "churn": feed_from_rows(spark, schemas.CHURN, list(churn)),
        "engagement": feed_from_rows(spark, schemas.ENGAGEMENT, list(eng)),
    }


def with_(row, **kw):
    out = dict(row)
    out.update(kw)
    return out
