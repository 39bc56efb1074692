"""DuckDB SQL for each registered query (the cross-engine correctness gate).

Written from the models' definitions, in plain SQL over the driver's views
(orders, lineitem, customer, nation, region, events). The feed CTEs restate
the derivation rules of ``ledgerline.sources.feeds``.

Dialect notes: EXTRACT is BIGINT in DuckDB (cast to INTEGER), SUM(BIGINT) is
HUGEINT (cast to BIGINT). A mean of NUMERIC is NUMERIC: whole billionths are
summed as integers and divided half up. ANY_VALUE is the least (order...,
values...) struct, as in the Spark code.
"""

from __future__ import annotations

REF_SPINE = ("2018-01-01", "2024-12-01")
DATA_SPINE = ("1995-01-01", "2024-12-01")


def _cte_sub(inject: bool) -> str:
    annual = "round(CAST(o.o_totalprice AS DECIMAL(18,2)) * 12, 2)"
    user = "CAST(o.o_custkey AS VARCHAR)"
    if inject:
        user = f"CASE WHEN o.o_orderkey % 499 <> 3 THEN {user} END"
        annual = f"CASE WHEN o.o_orderkey % 997 = 0 THEN CAST(0 AS DECIMAL(18,2)) ELSE {annual} END"
    return f"""
sub AS (
  SELECT
    CAST(o.o_orderkey AS VARCHAR) AS subscription_id,
    {user} AS user_id,
    CAST(o.o_orderdate AS TIMESTAMP) AS event_time,
    CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) AS DECIMAL(38,9)) AS subscription_amount,
    CASE o.o_orderstatus WHEN 'O' THEN 'new_subscription' WHEN 'F' THEN 'renewal'
         ELSE 'cancellation' END AS event_type,
    CASE o.o_orderpriority WHEN '1-URGENT' THEN 'enterprise' WHEN '2-HIGH' THEN 'pro'
         ELSE 'basic' END AS subscription_plan,
    r.r_name AS region,
    c.c_mktsegment AS user_segment,
    CAST((o.o_orderkey % 5 + 1) * 12 AS BIGINT) AS contract_length_months,
    c.c_acctbal > 0 AS capital_eligibility,
    CAST(CAST(o.o_orderkey % 2001 - 1000 AS DECIMAL(18,0)) * 0.001 AS DECIMAL(38,9)) AS growth_rate,
    CAST({annual} AS DECIMAL(38,9)) AS annualized_revenue,
    o.o_orderstatus = 'F' AS billing_connection_status,
    CAST(CAST(o.o_orderkey % 10007 - 5003 AS DECIMAL(18,0)) * 0.00012345 AS DECIMAL(38,9)) AS customer_growth_rate,
    CAST(o.o_orderkey % 100 + 1 AS BIGINT) AS bank_connection_quality
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
)"""


def _cte_rev(inject: bool) -> str:
    status = ("CASE l_returnflag WHEN 'N' THEN 'on_track' WHEN 'R' THEN 'delayed' "
              "WHEN 'A' THEN 'completed' END")
    delinquency = ("CASE WHEN status = 'delayed' THEN "
                   "(CASE WHEN l_linestatus = 'F' THEN 'payment_failure' ELSE 'no_payment' END) "
                   "ELSE 'no_delinquency' END")
    trend = ("CASE WHEN l_quantity < 17 THEN 'declining' WHEN l_quantity < 34 THEN 'stable' "
             "ELSE 'increasing' END")
    out_status, out_delinq, out_trend = "status", "delinquency", "trend"
    if inject:
        out_delinq = ("CASE WHEN l_linenumber = 6 AND status = 'delayed' THEN 'no_delinquency' "
                      "ELSE delinquency END")
        out_status = "CASE WHEN l_linenumber = 7 THEN 'paused' ELSE status END"
        out_trend = "CASE WHEN l_quantity = 50 THEN NULL ELSE trend END"
    return f"""
rev_base AS (
  SELECT l.*, o.o_custkey, {status} AS status, {trend} AS trend
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
rev_base2 AS (SELECT *, {delinquency} AS delinquency FROM rev_base),
rev AS (
  SELECT
    concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS revenue_id,
    CAST(o_custkey AS VARCHAR) AS user_id,
    CAST(l_shipdate AS TIMESTAMP) AS event_time,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DECIMAL(38,9)) AS payment_amount,
    (['credit_card', 'paypal', 'bank_transfer'])[l_linenumber % 3 + 1] AS payment_method,
    CAST(CAST(l_discount AS DECIMAL(18,2)) * 100 AS DECIMAL(38,9)) AS discount_applied,
    (['USD', 'EUR', 'GBP'])[l_suppkey % 3 + 1] AS currency,
    'inv-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS invoice_id,
    (['monthly', 'quarterly', 'annual'])[l_partkey % 3 + 1] AS recurring_period,
    CAST(l_shipdate AS TIMESTAMP) + INTERVAL 30 DAY AS due_date,
    l_linestatus = 'O' AS capital_utilization,
    CAST(l_quantity AS BIGINT) AS revenue_stability_score,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2)))
         AS DECIMAL(38,9)) AS advance_amount,
    CAST(3 + CAST(l_tax AS DECIMAL(18,2)) * 100 AS DECIMAL(38,9)) AS repayment_percentage,
    {out_status} AS repayment_status,
    {out_trend} AS revenue_trend,
    CAST(CAST(l_discount AS DECIMAL(18,2)) AS DECIMAL(38,9)) AS revenue_volatility,
    l_tax >= 0.04 AS capital_offer_accepted,
    {out_delinq} AS payment_delinquency
  FROM rev_base2
)"""


def _cte_events() -> str:
    return """
ev AS (
  SELECT *, COALESCE(CAST(json_extract(props, '$.k') AS BIGINT), 0) AS k FROM events
)"""


def _cte_churn(inject: bool) -> str:
    risk_out = "CASE WHEN user_id % 37 = 0 THEN CAST(1.004 AS DECIMAL(38,9)) ELSE risk END" if inject else "risk"
    return f"""
churn_base AS (
  SELECT *,
    k % 9 AS tickets,
    greatest(CAST(0 AS DECIMAL(18,2)), least(CAST(value AS DECIMAL(18,2)), CAST(100 AS DECIMAL(18,2))))
      AS drop_pct,
    k % 10 + 1 AS sat,
    CAST(event_id % 1000 AS DECIMAL(18,0)) * 0.001 AS base
  FROM ev WHERE event_type = 'error'
),
churn_scored AS (
  SELECT *, CAST(round(raw_risk, 2) AS DECIMAL(38,9)) AS risk
  FROM (SELECT *, greatest(0, least(base + tickets * 0.1 + drop_pct * 0.005 - sat * 0.04, 1)) AS raw_risk FROM churn_base)
),
churn AS (
  SELECT
    CAST(event_id AS VARCHAR) AS churn_event_id,
    CAST(user_id AS VARCHAR) AS user_id,
    CAST(ts AS TIMESTAMP) AS event_time,
    {risk_out} AS churn_risk,
    CAST(user_id % 2000 AS BIGINT) AS customer_tenure_days,
    CAST(event_id % 90 AS BIGINT) AS last_activity_gap_days,
    CAST(tickets AS BIGINT) AS support_ticket_count,
    CAST(drop_pct AS DECIMAL(38,9)) AS usage_drop_percentage,
    CAST(sat AS BIGINT) AS satisfaction_score,
    event_id % 2 = 0 AS recent_capital_offer,
    CASE WHEN k % 7 = 0 THEN NULL
         WHEN raw_risk > 0.8 THEN (['pricing', 'lack_of_feature', 'competitor', 'other'])[event_id % 4 + 1]
         ELSE 'none' END AS cancellation_reason,
    CASE WHEN k % 11 = 0 THEN NULL
         WHEN raw_risk > 0.8 THEN event_id % 2 = 1
         ELSE false END AS capital_withdrawal_flag
  FROM churn_scored
)"""


def _cte_eng(inject: bool) -> str:
    score = "round(greatest(CAST(1 AS DECIMAL(18,2)), least(CAST(value AS DECIMAL(18,2)), CAST(100 AS DECIMAL(18,2)))), 0)"
    if inject:
        score = f"CASE WHEN user_id % 41 = 0 THEN 101 ELSE {score} END"
    return f"""
eng AS (
  SELECT
    CAST(event_id AS VARCHAR) AS engagement_id,
    CAST(user_id AS VARCHAR) AS user_id,
    CAST(ts AS TIMESTAMP) AS event_time,
    CAST({score} AS BIGINT) AS engagement_score,
    CAST(CAST(value AS DECIMAL(18,2)) AS DECIMAL(38,9)) AS session_duration,
    CAST(CASE WHEN event_type = 'view' THEN k % 5 + 1 ELSE 0 END AS BIGINT) AS login_count,
    CAST(k % 8 AS BIGINT) AS dashboard_views,
    CAST(k % 4 AS BIGINT) AS financing_inquiries,
    CAST(CASE WHEN event_type = 'click' THEN k % 3 + 1 ELSE 0 END AS BIGINT) AS feature_interaction_count,
    CAST(k AS BIGINT) AS api_request_count,
    CAST(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS BIGINT) AS referral_count,
    CAST(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS BIGINT) AS capital_access_count,
    CAST(k % 3 AS BIGINT) AS report_download_count,
    CAST(k % 5 AS BIGINT) AS integration_usage,
    CAST(CASE WHEN k % 4 = 0 THEN 0 ELSE CAST(k % 100 AS DECIMAL(18,0)) * 0.01 END
         AS DECIMAL(38,9)) AS financing_conversion_rate,
    CAST(k % 100 + 1 AS BIGINT) AS platform_dependency_score,
    k % 2 = 0 AS connected_account_status,
    CAST(CASE WHEN k % 2 = 0 THEN k ELSE k // 10 END AS BIGINT) AS revenue_insights_views
  FROM ev WHERE event_type <> 'error'
)"""


def feeds_cte(inject: bool = False) -> str:
    """WITH-list body defining sub, rev, churn, eng (no leading WITH)."""
    return ",".join([_cte_sub(inject), _cte_rev(inject), _cte_events(),
                     _cte_churn(inject), _cte_eng(inject)])


def _mean(col: str) -> str:
    """The mean of a DECIMAL(38,9) column, half up at nine places, by whole numbers."""
    total, n = f"sum(CAST({col} * 1000000000 AS HUGEINT))", f"count({col})"
    return (f"CASE WHEN {n} > 0 THEN CAST(CAST(sign({total}) * ((abs({total}) * 2 + {n}) // (2 * greatest({n}, 1))) "
            f"AS DECIMAL(28,0)) * 0.000000001 AS DECIMAL(38,9)) END")


def _imean(col: str) -> str:
    return f"CAST(sum({col}) AS DOUBLE) / count({col})"


def _ym(ts: str = "event_time") -> str:
    return (f"CAST(extract(month FROM {ts}) AS INTEGER) AS month, "
            f"CAST(extract(year FROM {ts}) AS INTEGER) AS year")


def _pick(order: list[str], values: list[str]) -> str:
    fields = [f"'o{i}': {o}" for i, o in enumerate(order)] + [f"'{v}': {v}" for v in values]
    return "min({" + ", ".join(fields) + "})"


def _x(struct: str, field: str) -> str:
    return f"struct_extract({struct}, '{field}') AS {field}"


def agg_ctes() -> str:
    return f"""
agg_sub AS (
  SELECT user_id, month, year,
    {_x('p', 'subscription_plan')}, {_x('p', 'region')}, {_x('p', 'user_segment')},
    avg_growth_rate, total_annualized_revenue, avg_customer_growth_rate
  FROM (
    SELECT user_id, {_ym()},
      {_pick(['event_time', 'subscription_id'], ['subscription_plan', 'region', 'user_segment'])} AS p,
      {_mean('growth_rate')} AS avg_growth_rate,
      sum(annualized_revenue) AS total_annualized_revenue,
      {_mean('customer_growth_rate')} AS avg_customer_growth_rate
    FROM sub GROUP BY 1, 2, 3)
),
agg_rev AS (
  SELECT user_id, month, year, total_payment_amount, avg_revenue_stability_score, total_advance_amount,
    {_x('p', 'repayment_status')}, {_x('p', 'revenue_trend')}, avg_revenue_volatility,
    {_x('p', 'payment_delinquency')}
  FROM (
    SELECT user_id, {_ym()},
      sum(payment_amount) AS total_payment_amount,
      {_imean('revenue_stability_score')} AS avg_revenue_stability_score,
      sum(advance_amount) AS total_advance_amount,
      {_pick(['event_time', 'revenue_id'], ['repayment_status', 'revenue_trend', 'payment_delinquency'])} AS p,
      {_mean('revenue_volatility')} AS avg_revenue_volatility
    FROM rev GROUP BY 1, 2, 3)
),
agg_churn AS (
  SELECT user_id, month, year, avg_churn_risk, avg_customer_tenure, avg_last_activity_gap,
    total_support_ticket_count, avg_usage_drop_percentage, avg_satisfaction_score,
    {_x('p', 'cancellation_reason')}, {_x('p', 'capital_withdrawal_flag')}
  FROM (
    SELECT user_id, {_ym()},
      {_mean('churn_risk')} AS avg_churn_risk,
      {_imean('customer_tenure_days')} AS avg_customer_tenure,
      {_imean('last_activity_gap_days')} AS avg_last_activity_gap,
      CAST(sum(support_ticket_count) AS BIGINT) AS total_support_ticket_count,
      {_mean('usage_drop_percentage')} AS avg_usage_drop_percentage,
      {_imean('satisfaction_score')} AS avg_satisfaction_score,
      {_pick(['event_time', 'churn_event_id'], ['cancellation_reason', 'capital_withdrawal_flag'])} AS p
    FROM churn GROUP BY 1, 2, 3)
),
agg_engage AS (
  SELECT user_id, {_ym()},
    {_imean('engagement_score')} AS avg_engagement_score,
    {_mean('session_duration')} AS avg_session_duration,
    CAST(sum(login_count) AS BIGINT) AS total_login_count,
    CAST(sum(financing_inquiries) AS BIGINT) AS total_financing_inquiries,
    CAST(sum(feature_interaction_count) AS BIGINT) AS total_feature_interaction_count,
    CAST(sum(capital_access_count) AS BIGINT) AS total_capital_access_count
  FROM eng GROUP BY 1, 2, 3
)"""


def users_cte() -> str:
    """Everyone any feed names."""
    named = " UNION ALL ".join(f"SELECT user_id FROM {feed}" for feed in ("eng", "churn", "rev", "sub"))
    return f"\ndistinct_users AS (SELECT DISTINCT user_id FROM ({named}))"


def calendar_cte(spine, users: str = "distinct_users") -> str:
    """Months are counted: number n is month n % 12 + 1 of year n // 12."""
    first, last = (int(str(day)[:4]) * 12 + int(str(day)[5:7]) - 1 for day in spine)
    return f"""
calendar AS (
  SELECT user_id, CAST(n // 12 AS INTEGER) AS year, CAST(n % 12 + 1 AS INTEGER) AS month,
    printf('%04d-%02d', n // 12, n % 12 + 1) AS month_year
  FROM range({first}, {last + 1}) AS months(n), {users}
)"""


D38 = "CAST(0 AS DECIMAL(38,9))"
# The model's columns after its keys, each with what an empty month shows.
FILLED_COLUMNS = [
    ("subscription_plan", "'N/A'"),
    ("region", "'N/A'"),
    ("user_segment", "'N/A'"),
    ("avg_growth_rate", D38),
    ("total_annualized_revenue", D38),
    ("avg_customer_growth_rate", D38),
    ("total_payment_amount", D38),
    ("avg_revenue_stability_score", "0.0"),
    ("total_advance_amount", D38),
    ("repayment_status", "'N/A'"),
    ("revenue_trend", "'N/A'"),
    ("avg_revenue_volatility", D38),
    ("payment_delinquency", "'N/A'"),
    ("avg_churn_risk", D38),
    ("avg_customer_tenure", "0.0"),
    ("avg_last_activity_gap", "0.0"),
    ("total_support_ticket_count", "CAST(0 AS BIGINT)"),
    ("avg_usage_drop_percentage", D38),
    ("avg_satisfaction_score", "0.0"),
    ("cancellation_reason", "'N/A'"),
    ("capital_withdrawal_flag", "FALSE"),
    ("avg_engagement_score", "0.0"),
    ("avg_session_duration", D38),
    ("total_login_count", "CAST(0 AS BIGINT)"),
    ("total_financing_inquiries", "CAST(0 AS BIGINT)"),
    ("total_feature_interaction_count", "CAST(0 AS BIGINT)"),
    ("total_capital_access_count", "CAST(0 AS BIGINT)"),
]


def summary_cte(spine, inject: bool = False, feeds: str | None = None) -> str:
    """WITH-list body ending in ``customer_summary``: the grid, and beside each cell what the roll-ups have for it."""
    filled = ", ".join(f"coalesce({c}, {fill}) AS {c}" for c, fill in FILLED_COLUMNS)
    return ",".join([
        feeds or feeds_cte(inject), users_cte(), calendar_cte(spine), agg_ctes(),
        f"""
customer_summary AS (
  SELECT user_id, year, month, month_year, {filled}
  FROM calendar
  LEFT JOIN agg_sub USING (user_id, year, month)
  LEFT JOIN agg_rev USING (user_id, year, month)
  LEFT JOIN agg_churn USING (user_id, year, month)
  LEFT JOIN agg_engage USING (user_id, year, month)
)"""])


def ts_ctes() -> str:
    return f"""
rev_ts AS (
  SELECT user_id, event_time, month, year, total_payment_amount,
    {_x('p', 'capital_utilization')}, avg_revenue_stability_score, total_advance_amount,
    {_x('p', 'repayment_status')}, {_x('p', 'revenue_trend')}, avg_revenue_volatility,
    {_x('p', 'payment_delinquency')}, {_x('p', 'capital_offer_accepted')}
  FROM (
    SELECT user_id, event_time, {_ym()},
      sum(payment_amount) AS total_payment_amount,
      {_pick(['revenue_id'], ['capital_utilization', 'repayment_status', 'revenue_trend',
                              'payment_delinquency', 'capital_offer_accepted'])} AS p,
      {_imean('revenue_stability_score')} AS avg_revenue_stability_score,
      sum(advance_amount) AS total_advance_amount,
      {_mean('revenue_volatility')} AS avg_revenue_volatility
    FROM rev GROUP BY user_id, event_time)
),
sub_ts AS (
  SELECT user_id, event_time, month, year,
    {_x('p', 'subscription_plan')}, {_x('p', 'region')}, {_x('p', 'user_segment')},
    avg_growth_rate, total_annualized_revenue, avg_customer_growth_rate
  FROM (
    SELECT user_id, event_time, {_ym()},
      {_pick(['subscription_id'], ['subscription_plan', 'region', 'user_segment'])} AS p,
      {_mean('growth_rate')} AS avg_growth_rate,
      sum(annualized_revenue) AS total_annualized_revenue,
      {_mean('customer_growth_rate')} AS avg_customer_growth_rate
    FROM sub GROUP BY user_id, event_time)
)"""


def srs_cte(inject: bool = False) -> str:
    """WITH-list body ending in ``subscription_revenue_summary``.

    Of a user's subscription times in a month, and of the revenue times on a day, the first
    stands for all; a revenue day is kept if its month has a subscription.
    """
    return ",".join([feeds_cte(inject), ts_ctes(), """
first_sub AS (
  SELECT * EXCLUDE (event_time, nth)
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id, year, month ORDER BY event_time) AS nth FROM sub_ts)
  WHERE nth = 1
),
first_rev AS (
  SELECT * EXCLUDE (event_time, nth), date_trunc('day', event_time) AS event_date
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id, date_trunc('day', event_time) ORDER BY event_time) AS nth FROM rev_ts)
  WHERE nth = 1
),
subscription_revenue_summary AS (
  SELECT *, strftime(event_date, '%Y-%m') AS month_year FROM first_rev JOIN first_sub USING (user_id, year, month)
)"""])


def _with(body: str, select: str) -> str:
    return f"WITH {body}\n{select}"


def build() -> dict[str, str]:
    """name -> DuckDB SQL, one per registered query that has an SQL equivalent."""
    q: dict[str, str] = {}
    q["customer_summary"] = _with(summary_cte(DATA_SPINE), "SELECT * FROM customer_summary")
    q["customer_summary_stacked"] = q["customer_summary"]
    q["customer_summary_star"] = q["customer_summary"]
    q["customer_summary_bucketed"] = q["customer_summary"]
    q["customer_summary_reference_spine"] = _with(summary_cte(REF_SPINE), "SELECT * FROM customer_summary")
    q["summary_sorted"] = _with(
        summary_cte(DATA_SPINE),
        "SELECT *, row_number() OVER (ORDER BY user_id, year, month, month_year) AS row_no FROM customer_summary")
    moved = (", moved_churn AS (SELECT * REPLACE (event_time - INTERVAL 312 MONTH AS event_time) FROM churn)"
             ", moved_eng AS (SELECT * REPLACE (event_time - INTERVAL 312 MONTH AS event_time) FROM eng)")
    body = summary_cte(DATA_SPINE, feeds=feeds_cte() + moved)
    q["customer_summary_all_feeds"] = _with(
        body.replace("FROM churn GROUP", "FROM moved_churn GROUP").replace("FROM eng GROUP", "FROM moved_eng GROUP"),
        "SELECT * FROM customer_summary")
    q["customer_month_slice"] = _with(
        ",".join([feeds_cte(), "\nsub_users AS (SELECT DISTINCT user_id FROM sub)",
                  calendar_cte(DATA_SPINE, "sub_users"), agg_ctes()]),
        "SELECT user_id, year, month, month_year, "
        + ", ".join(f"coalesce({c}, {fill}) AS {c}" for c, fill in FILLED_COLUMNS[:6])
        + " FROM calendar LEFT JOIN agg_sub USING (user_id, year, month)")
    q["subscription_revenue_summary"] = _with(srs_cte(), "SELECT * FROM subscription_revenue_summary")
    q["revenue_summary_bucketed"] = q["subscription_revenue_summary"]
    q["distinct_users"] = _with(",".join([feeds_cte(), users_cte()]), "SELECT * FROM distinct_users")
    q["month_spine"] = _with(",".join([feeds_cte(), users_cte(), calendar_cte(REF_SPINE)]),
                             "SELECT * FROM calendar")
    q["day_spine"] = _with(feeds_cte(), """SELECT user_id, CAST(d AS DATE) AS day, strftime(d, '%Y-%m') AS month_year
FROM (SELECT user_id, CAST(min(event_time) AS DATE) AS f, CAST(max(event_time) AS DATE) AS l
      FROM eng GROUP BY user_id) b
CROSS JOIN unnest(generate_series(b.f, b.l, INTERVAL 1 DAY)) AS s(d)""")
    for name in ("agg_sub", "agg_rev", "agg_churn", "agg_engage"):
        q[name] = _with(",".join([feeds_cte(), agg_ctes()]), f"SELECT * FROM {name}")
    for name in ("rev_ts", "sub_ts"):
        key = {"rev_ts": "rev_by_timestamp", "sub_ts": "sub_by_timestamp"}[name]
        q[key] = _with(",".join([feeds_cte(), ts_ctes()]), f"SELECT * FROM {name}")
    q.update(audit_queries())
    q.update(more_queries())
    return q


# --- audits -------------------------------------------------------------------
# The audits' value sets and column lists.

_IN = lambda col, vals: f"{col} NOT IN ({', '.join(repr(v) for v in vals)})"
_STATUS = ("on_track", "delayed", "completed")
_TREND = ("stable", "increasing", "declining")
_DELINQ = ("no_delinquency", "no_payment", "payment_failure")
AUDIT_SQL = {
    "aggregated_revenue_positive_customer_summary": (
        "customer_summary", "total_payment_amount <= 0 OR total_annualized_revenue <= 0"),
    "key_dimensions_not_null": (
        "customer_summary", "user_id IS NULL OR month IS NULL OR year IS NULL"),
    "allowed_repayment_and_trend": (
        "customer_summary",
        f"{_IN('repayment_status', _STATUS)} OR {_IN('revenue_trend', _TREND)} "
        f"OR {_IN('payment_delinquency', _DELINQ)}"),
    "churn_risk_within_range": ("customer_summary", "avg_churn_risk < 0 OR avg_churn_risk > 1"),
    "engagement_score_range": (
        "customer_summary", "avg_engagement_score < 0 OR avg_engagement_score > 100"),
    "aggregated_revenue_positive_customer_summary_skip_gaps": (
        "customer_summary",
        "(repayment_status <> 'N/A' AND total_payment_amount <= 0) "
        "OR (subscription_plan <> 'N/A' AND total_annualized_revenue <= 0)"),
    "allowed_repayment_and_trend_skip_gaps": (
        "customer_summary",
        f"repayment_status <> 'N/A' AND ({_IN('repayment_status', _STATUS)} "
        f"OR {_IN('revenue_trend', _TREND)} OR {_IN('payment_delinquency', _DELINQ)})"),
    "rev_not_null_check": (
        "subscription_revenue_summary",
        " OR ".join(f"{c} IS NULL" for c in (
            "user_id", "month", "year", "total_annualized_revenue", "total_payment_amount",
            "avg_revenue_stability_score", "total_advance_amount", "repayment_status",
            "revenue_trend", "avg_revenue_volatility", "payment_delinquency"))),
    "aggregated_revenue_positive_rev_summary": (
        "subscription_revenue_summary", "total_annualized_revenue <= 0"),
    "allowed_value_checks": (
        "subscription_revenue_summary",
        f"{_IN('repayment_status', _STATUS)} OR {_IN('revenue_trend', _TREND)}"),
    "repayment_delinquency_consistency": (
        "subscription_revenue_summary",
        "(repayment_status = 'delayed' AND payment_delinquency NOT IN ('no_payment', 'payment_failure')) "
        "OR (repayment_status <> 'delayed' AND payment_delinquency <> 'no_delinquency')"),
}
CUSTOMER_COUNT_ORDER = [
    "aggregated_revenue_positive_customer_summary", "key_dimensions_not_null",
    "allowed_repayment_and_trend", "churn_risk_within_range", "engagement_score_range",
    "aggregated_revenue_positive_customer_summary_skip_gaps", "allowed_repayment_and_trend_skip_gaps"]
REVENUE_COUNT_ORDER = ["rev_not_null_check", "aggregated_revenue_positive_rev_summary",
                       "allowed_value_checks", "repayment_delinquency_consistency"]


def _model_cte(model: str) -> str:
    return summary_cte(DATA_SPINE, inject=True) if model == "customer_summary" else srs_cte(inject=True)


def audit_queries() -> dict[str, str]:
    q = {}
    for name, (model, pred) in AUDIT_SQL.items():
        q[f"audit_rows_{name}"] = _with(_model_cte(model), f"SELECT * FROM {model} WHERE {pred}")
    for key, model, order in (("audit_counts_customer", "customer_summary", CUSTOMER_COUNT_ORDER),
                              ("audit_counts_revenue", "subscription_revenue_summary",
                               REVENUE_COUNT_ORDER)):
        cols = ",\n  ".join(
            f"CAST(count(*) FILTER (WHERE {AUDIT_SQL[n][1]}) AS BIGINT) AS {n}" for n in order)
        q[key] = _with(_model_cte(model), f"SELECT\n  {cols}\nFROM {model}")
    return q


# --- ingest, replay, streaming, restate, derived rules, lookups -----------------

def _season(month: str) -> str:
    return (f"CASE WHEN {month} IN (11, 12) THEN 'holiday' WHEN {month} IN (6, 7, 8) THEN 'summer' "
            f"ELSE 'regular' END")


def _digest(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 8))::BIGINT"


def more_queries() -> dict[str, str]:
    q = {}
    f = feeds_cte()
    q["json_ingest_valid"] = _with(
        f, "SELECT * FROM sub WHERE CAST(subscription_id AS BIGINT) % 997 NOT BETWEEN 1 AND 8")
    q["json_ingest_rejects"] = _with(f, """SELECT CASE r WHEN 8 THEN '' ELSE subscription_id END AS subscription_id,
  CASE WHEN r = 2 THEN 'missing:user_id' WHEN r = 8 THEN 'missing:subscription_id'
       WHEN r IN (5, 6, 7) THEN 'bad_timestamp:event_time' ELSE 'malformed' END AS reason
FROM (SELECT subscription_id, CAST(subscription_id AS BIGINT) % 997 AS r FROM sub) WHERE r BETWEEN 1 AND 8""")
    q["replay_dedup"] = _with(f, """SELECT * EXCLUDE (nth) FROM (
  SELECT *, row_number() OVER (PARTITION BY revenue_id ORDER BY user_id, event_time, payment_amount, payment_method,
    discount_applied, currency, invoice_id, recurring_period, due_date, capital_utilization, revenue_stability_score,
    advance_amount, repayment_percentage, repayment_status, revenue_trend, revenue_volatility, capital_offer_accepted,
    payment_delinquency) AS nth FROM rev)
WHERE nth = 1""")
    q["stream_ingest_roundtrip"] = _with(f, "SELECT * FROM eng")
    q["stream_ingest_tables"] = _with(f, " UNION ALL ".join(f"""SELECT '{table}' AS table_name,
  count(*) FILTER (ok) AS n_rows,
  CAST(coalesce(sum({_digest(f"concat_ws('|', {pk}, user_id, strftime(event_time, '%Y-%m-%d %H:%M:%S'))")}) FILTER (ok), 0) AS BIGINT) AS digest,
  count(*) FILTER (NOT ok) AS n_rejects, count(*) FILTER (no_id) AS without_id, count(*) FILTER (no_user) AS without_user
FROM (SELECT *, NOT no_id AND NOT no_user AS ok FROM (
  SELECT *, {_digest(pk)} % 97 = 1 AS no_id, {_digest(pk)} % 101 = 1 AS no_user FROM {feed}))"""
        for feed, pk, table in (
            ("sub", "subscription_id", "raw_subscription_events"), ("rev", "revenue_id", "raw_revenue_events"),
            ("churn", "churn_event_id", "raw_churn_events"), ("eng", "engagement_id", "raw_customer_engagement_events"))))
    q["stream_ingest_by_name"] = _with(f, " UNION ALL ".join(f"""SELECT '{table}' AS table_name, count(*) AS n_rows,
  CAST(coalesce(sum({_digest(f"concat_ws('|', {pk}, user_id, strftime(event_time, '%Y-%m-%d %H:%M:%S'))")}), 0) AS BIGINT) AS digest
FROM (SELECT * FROM {feed} WHERE {kept})"""
        for feed, pk, table, kept in (
            ("sub", "subscription_id", "raw_subscription_events", "true"), ("rev", "revenue_id", "raw_revenue_events", "true"),
            ("churn", "churn_event_id", "raw_churn_events", "false"), ("eng", "engagement_id", "raw_customer_engagement_events", "false"))))
    q["ingest_replays_refused"] = _with(f, f"""SELECT 'raw_revenue_events' AS table_name, count(*) FILTER (ok) AS n_rows,
  CAST(coalesce(sum({_digest("concat_ws('|', revenue_id, user_id, strftime(event_time, '%Y-%m-%d %H:%M:%S'))")}) FILTER (ok), 0) AS BIGINT) AS digest,
  count(*) FILTER (NOT ok) AS n_rejects, count(*) FILTER (ok AND late) AS n_late
FROM (SELECT *, {_digest("revenue_id")} % 101 <> 1 AS ok, {_digest("revenue_id")} % 5 = 0 AS late FROM rev)""")
    q["ingest_compacted"] = _with(f, "SELECT * FROM eng")
    q["restate_month"] = _with(summary_cte(DATA_SPINE), "SELECT * FROM customer_summary")
    q["restate_new_users"] = q["restate_month"]
    q["restate_revenue_months"] = _with(srs_cte(), "SELECT * FROM subscription_revenue_summary")
    q["rebuild_revenue"] = q["restate_revenue_months"]
    q["restate_one_commit"] = q["restate_revenue_months"]
    q["incremental_customer_summary"] = q["restate_month"]
    q["incremental_revenue_summary"] = q["restate_revenue_months"]
    q["derived_subscription"] = _with(f, f"""SELECT subscription_id,
  CAST(round(CAST(subscription_amount AS DECIMAL(18,2)) * 12, 2) AS DECIMAL(38,9)) AS annualized,
  {_season('extract(month FROM event_time)')} AS season,
  CASE WHEN CAST(subscription_id AS BIGINT) % 11 <> 0
       THEN CAST(greatest(-0.5, least(growth_rate, 0.5)) AS DECIMAL(38,9)) END AS clipped_growth_rate
FROM sub""")
    q["derived_revenue"] = _with(f, f"""SELECT revenue_id,
  event_time + INTERVAL 30 DAY AS due_date_rule,
  CASE WHEN strftime(event_time, '%f') = '000000' THEN strftime(event_time, '%Y-%m-%dT%H:%M:%S UTC')
       ELSE strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f UTC') END AS event_time_text,
  {_season('extract(month FROM event_time)')} AS season,
  CASE WHEN repayment_status = 'delayed'
       THEN (CASE WHEN capital_utilization THEN 'payment_failure' ELSE 'no_payment' END)
       ELSE 'no_delinquency' END AS delinquency_rule
FROM rev""")
    q["derived_churn"] = _with(f, """SELECT churn_event_id,
  CAST(round(raw_risk, 2) AS DECIMAL(38,9)) AS churn_score_rule,
  CASE WHEN raw_risk > 0.8 THEN 'other' ELSE 'none' END AS reason_rule,
  CASE WHEN raw_risk > 0.8 THEN id % 2 = 1 ELSE false END AS withdrawal_rule
FROM (SELECT churn_event_id, CAST(churn_event_id AS BIGINT) AS id,
        CASE WHEN CAST(churn_event_id AS BIGINT) % 13 <> 0 THEN
          greatest(0, least(CAST(CAST(churn_event_id AS BIGINT) % 1000 AS DECIMAL(18,0)) * 0.001
                            + support_ticket_count * 0.1 + CAST(usage_drop_percentage AS DECIMAL(18,2)) * 0.005
                            - satisfaction_score * 0.04, 1)) END AS raw_risk
      FROM churn)""")
    q["derived_engagement"] = _with(f, """SELECT engagement_id,
  CAST(CASE WHEN financing_inquiries = 0 THEN 0 ELSE financing_conversion_rate END AS DECIMAL(38,9))
    AS guarded_rate_rule,
  CAST(greatest(10, least(engagement_score, 90)) AS BIGINT) AS clipped_score
FROM eng""")
    q["profile_lookup"] = _with(f, """SELECT r.user_id, r.revenue_id, r.payment_amount,
  p.region, p.user_segment, p.default_plan
FROM rev r LEFT JOIN (
  SELECT CAST(c.c_custkey AS VARCHAR) AS user_id, rg.r_name AS region, c.c_mktsegment AS user_segment,
         (['basic', 'pro', 'enterprise'])[c.c_custkey % 3 + 1] AS default_plan
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region rg ON n.n_regionkey = rg.r_regionkey) p ON r.user_id = p.user_id""")
    q["cohort_month"] = _with(",".join([f, users_cte(), calendar_cte(REF_SPINE)]), """SELECT * FROM calendar c
WHERE EXISTS (SELECT 1 FROM churn ch WHERE ch.user_id = c.user_id
              AND CAST(extract(year FROM ch.event_time) AS INTEGER) = c.year
              AND CAST(extract(month FROM ch.event_time) AS INTEGER) = c.month)""")
    return q
