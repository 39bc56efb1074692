"""ledgerline: customer-month analytics for subscription businesses on Spark.

Event feeds (subscriptions, revenue, churn, engagement) are ingested as JSON
streams or tables, validated against fixed typed schemas, and rolled up into
two models: a dense customer x month summary and a per-revenue-day
subscription/revenue summary, each with its data-quality audits.

Everything is expressed with the DataFrame / SQL / Structured Streaming APIs;
Catalyst and AQE choose the physical plan.
"""

from ledgerline.session import ensure_utc, get_session, work_dir

__all__ = ["ensure_utc", "get_session", "work_dir"]
