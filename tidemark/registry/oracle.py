"""The same results as SQL for DuckDB, written from the definitions.

Views below are put in front of a query where it names them. Where the Spark
side rewrites (rolling windows, pre-aggregated joins, stacked tables), the SQL
stays with the plain form.
"""

from __future__ import annotations

import re

TS_MS = 1_706_659_200_000
DAY_MS = 86_400_000

VIEWS: dict[str, str] = {}
ORACLE: dict[str, str] = {}


def _needed(sql: str, seen: list[str]) -> None:
    words = set(re.findall(r"\w+", sql))
    for name, body in VIEWS.items():
        if name in words and name not in seen:
            _needed(body, seen)
            if name not in seen:
                seen.append(name)


def with_views(sql: str, events: str = "") -> str:
    """The query behind the views that it names; ``events`` takes the place of the staged events."""
    names: list[str] = []
    _needed(events, names)
    _needed(sql, names)
    if not names:
        return sql
    bodies = VIEWS | ({"s_events": events} if events else {})
    return "WITH " + ",\n".join(f"{name} AS ({bodies[name]})" for name in names) + "\n" + sql


def exact1(x: str) -> str:
    """One decimal, from the exact binary value, ties to even."""
    return f"CAST(format('{{:.1f}}', {x}) AS DOUBLE)"


def exact2(x: str) -> str:
    return f"CAST(format('{{:.2f}}', {x}) AS DOUBLE)"


def exact1_up(x: str) -> str:
    """One decimal, exact ties (multiples of 1/8 only) upward."""
    return f"CASE WHEN {x} * 8 = floor({x} * 8) THEN floor({x} * 10 + 0.5) / 10 ELSE {exact1(x)} END"


# Raw tables

VIEWS["v_raw_users"] = """
SELECT c_custkey AS id, CAST(c_custkey AS VARCHAR) AS user_id, ' ' || c_name || '@Example.com' AS email,
  c_mktsegment AS role, CASE WHEN c_acctbal < 0 THEN 'Inactive' END AS status,
  CASE c_nationkey % 5 WHEN 0 THEN 'iOS' WHEN 1 THEN 'Android' WHEN 2 THEN 'Web' WHEN 3 THEN 'Desktop' END AS platform,
  CASE WHEN c_nationkey % 4 <> 0 THEN 'C' || CAST(c_nationkey AS VARCHAR) END AS country_code,
  CAST(DATE '2023-12-20' + CAST(c_custkey % 45 AS INTEGER) AS TIMESTAMP) AS created_at,
  CAST(NULL AS TIMESTAMP) AS updated_at
FROM customer"""
VIEWS["v_raw_events"] = """
SELECT event_id AS id, CASE WHEN event_id % 41 <> 0 THEN CAST(user_id AS VARCHAR) END AS user_id,
  CASE WHEN event_id % 50 <> 0 THEN CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) END AS session_id,
  CASE WHEN event_id % 7 = 0 THEN '  ' || upper(event_type) || ' ' ELSE event_type END AS event_name,
  CASE WHEN event_type IN ('view', 'click') THEN 'Navigation' END AS event_category,
  CASE event_id % 6 WHEN 0 THEN 'iOS 17.2' WHEN 1 THEN 'Android 14' WHEN 2 THEN 'Web/Chrome' WHEN 3 THEN 'macOS'
    WHEN 4 THEN 'ANDROID' END AS platform,
  CASE WHEN event_id % 9 <> 0 THEN '2.1.0' END AS app_version, props AS properties_json, ts AS created_at
FROM events"""
VIEWS["v_raw_tx"] = """
SELECT event_id AS id,
  CASE WHEN event_id % 53 = 0 THEN NULL WHEN event_id % 97 = 0 THEN CAST(user_id + 10000000 AS VARCHAR)
    ELSE CAST(user_id AS VARCHAR) END AS user_id,
  CASE WHEN event_id % 3 = 0 THEN floor(value * 10) / 10 + 0.005 ELSE value END AS amount, CASE user_id % 3 WHEN 0 THEN 'brl' WHEN 1 THEN 'USD' END AS currency,
  CASE CAST(floor(value) AS BIGINT) % 6 WHEN 0 THEN 'Completed' WHEN 1 THEN 'PAID' WHEN 2 THEN 'pending'
    WHEN 3 THEN 'failed' WHEN 4 THEN 'approved' END AS status,
  CASE event_id % 4 WHEN 0 THEN 'PIX' WHEN 1 THEN 'credit_card' WHEN 2 THEN 'paypal' END AS payment_method,
  ts AS created_at, CASE event_id % 5 WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S-03:00')
    WHEN 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS updated_at
FROM events WHERE event_type = 'purchase'"""
VIEWS["v_raw_orders"] = """
SELECT o_orderkey AS id, CAST(o_custkey AS VARCHAR) AS user_id, o_totalprice AS amount, CAST(NULL AS VARCHAR) AS currency,
  CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'approved' WHEN 'P' THEN 'pending' END AS status,
  o_orderpriority AS payment_method, o_orderdate AS created_at, CAST(NULL AS TIMESTAMP) AS updated_at
FROM orders"""

ORACLE["raw_users"] = "SELECT * FROM v_raw_users"
ORACLE["raw_analytics_events"] = "SELECT * FROM v_raw_events"
ORACLE["raw_transactions"] = "SELECT * FROM v_raw_tx"
ORACLE["raw_order_transactions"] = "SELECT * FROM v_raw_orders"
ORACLE["read_parquet_raw"] = "SELECT * FROM events"
ORACLE["write_snapshot"] = "SELECT * FROM v_raw_users"
ORACLE["register_raw"] = """
SELECT 'raw_users' AS table_name, count(*) AS row_count FROM v_raw_users
UNION ALL SELECT 'raw_analytics_events', count(*) FROM v_raw_events
UNION ALL SELECT 'raw_transactions', count(*) FROM v_raw_tx"""

# Staging

FOLD = """CASE WHEN contains(lower(platform), 'ios') THEN 'ios'
  WHEN contains(lower(platform), 'android') THEN 'android' ELSE 'web' END"""
VIEWS["s_users"] = """
SELECT coalesce(user_id, CAST(id AS VARCHAR)) AS user_id, trim(lower(email)) AS email,
  lower(coalesce(role, 'customer')) AS user_role, lower(coalesce(status, 'active')) AS user_status,
  lower(coalesce(platform, 'web')) AS platform, coalesce(country_code, 'BR') AS country_code, created_at,
  coalesce(updated_at, created_at) AS updated_at, CAST(created_at AS DATE) AS registration_date
FROM v_raw_users WHERE id IS NOT NULL"""


def staged_events(source: str) -> str:
    return f"""
SELECT CAST(id AS VARCHAR) AS event_id, user_id, coalesce(session_id, 'unknown_session') AS session_id,
  lower(trim(event_name)) AS event_name, lower(coalesce(event_category, 'general')) AS event_category,
  {FOLD} AS platform, coalesce(app_version, '1.0.0') AS app_version, properties_json, created_at,
  CAST(created_at AS DATE) AS event_date
FROM {source} WHERE id IS NOT NULL AND event_name IS NOT NULL"""


# Text times of the stand-in tables: UTC, or with the one offset that occurs there.
OFFSET_TIME = """CASE WHEN CAST(updated_at AS VARCHAR) LIKE '%-03:00'
    THEN CAST(left(CAST(updated_at AS VARCHAR), 19) AS TIMESTAMP) + INTERVAL 3 HOUR ELSE CAST(updated_at AS TIMESTAMP) END"""


def staged_transactions(source: str) -> str:
    return f"""
SELECT CAST(id AS VARCHAR) AS transaction_id, user_id, CAST(coalesce(amount, 0.0) AS DECIMAL(12, 2)) AS amount,
  upper(coalesce(currency, 'BRL')) AS currency, lower(coalesce(status, 'completed')) AS status,
  lower(coalesce(payment_method, 'unknown')) AS payment_method, created_at,
  coalesce({OFFSET_TIME}, created_at) AS updated_at, CAST(created_at AS DATE) AS transaction_date,
  CASE WHEN lower(status) IN ('completed', 'success', 'paid', 'approved') THEN 1 ELSE 0 END AS is_successful
FROM {source} WHERE id IS NOT NULL"""


VIEWS["s_events"] = staged_events("v_raw_events")
VIEWS["s_tx"] = staged_transactions("v_raw_tx")
VIEWS["s_orders"] = staged_transactions("v_raw_orders")
ORACLE["stg_users"] = "SELECT * FROM s_users"
ORACLE["stg_events"] = "SELECT * FROM s_events"
ORACLE["stg_transactions"] = "SELECT * FROM s_tx"
ORACLE["events_filtered"] = """
SELECT * FROM s_events WHERE event_name = 'click' AND event_category = 'navigation' AND platform = 'android'
  AND created_at BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-20 00:00:00'"""

# Report rows as events

VIEWS["v_ga4"] = """
SELECT strftime(ts, '%Y%m%d') AS date,
  CASE event_type WHEN 'view' THEN 'screen_view' WHEN 'click' THEN 'page_view' ELSE event_type END AS "eventName",
  'screen "' || regexp_extract(props, '[0-9]+') || '"' AS "unifiedScreenName",
  CASE event_id % 3 WHEN 0 THEN 'iOS' WHEN 1 THEN 'Android' WHEN 2 THEN 'Desktop Web' END AS platform,
  count(*) AS "eventCount", min(event_id) AS report_order
FROM events GROUP BY 1, 2, 3, 4"""
VIEWS["v_ga4_events"] = f"""
SELECT 'ga4_' || place AS id, 'ga4_user_' || (place % 50 + 1) AS user_id, 'ga4_sess_' || date || '_' || place AS session_id,
  CASE WHEN "eventName" IN ('screen_view', 'page_view') THEN "unifiedScreenName" ELSE "eventName" END AS event_name,
  CASE WHEN "eventName" IN ('screen_view', 'page_view') THEN 'ga4_screen_view' ELSE 'ga4_event' END AS event_category,
  {FOLD} AS platform, '1.0.0' AS app_version,
  '{{"ga4_event": "' || "eventName" || '", "screen": "' || replace("unifiedScreenName", '"', '\\"')
    || '", "event_count": ' || "eventCount" || '}}' AS properties_json,
  CAST(strptime(date, '%Y%m%d') AS TIMESTAMP) + INTERVAL 12 HOUR AS created_at
FROM (SELECT *, CAST(row_number() OVER (ORDER BY report_order) AS VARCHAR)::BIGINT AS place FROM v_ga4)"""
VIEWS["v_both_sources"] = """
SELECT CAST(id AS VARCHAR) AS id, user_id, session_id, event_name, event_category, platform, app_version, properties_json, created_at
FROM v_raw_events
UNION ALL SELECT id, user_id, session_id, event_name, event_category, platform, app_version, properties_json, created_at
FROM v_ga4_events"""
VIEWS["s_both"] = staged_events("v_both_sources")
ORACLE["ga4_normalize"] = "SELECT * FROM v_ga4_events"


def platform_events(source: str) -> str:
    return f"""
SELECT event_date AS metric_date, platform, count(*) AS events_count, count(DISTINCT session_id) AS sessions_count,
  count(DISTINCT user_id) AS active_users_count
FROM {source} GROUP BY 1, 2"""


ORACLE["union_event_sources"] = platform_events("s_both")

# Aggregates

MONEY = "CAST({} AS DECIMAL(38, 2))"
PAID = MONEY.format("coalesce(sum(amount) FILTER (WHERE is_successful = 1), 0)")

ORACLE["activity_rollup"] = """
SELECT event_date, event_name, platform, user_id, session_id, count(*) AS events_in_row,
  min(created_at) AS first_at, max(created_at) AS last_at
FROM s_events GROUP BY ALL"""
VIEWS["u_events"] = """
SELECT user_id, min(created_at) AS first_event_at, max(created_at) AS last_event_at, min(event_date) AS first_event_date,
  max(event_date) AS last_event_date, count(*) AS total_events_count, count(DISTINCT event_date) AS total_active_days,
  count(DISTINCT session_id) AS total_sessions_count
FROM s_events WHERE user_id IS NOT NULL GROUP BY user_id"""
VIEWS["u_tx"] = f"""
SELECT user_id, min(created_at) AS first_transaction_at, max(created_at) AS last_transaction_at,
  min(transaction_date) AS first_transaction_date, max(transaction_date) AS last_transaction_date,
  count(*) AS total_transactions_count, CAST(sum(is_successful) AS BIGINT) AS successful_transactions_count,
  {PAID} AS lifetime_value_amount
FROM s_tx WHERE user_id IS NOT NULL GROUP BY user_id"""
VIEWS["d_new"] = """
SELECT registration_date AS metric_date, count(DISTINCT user_id) AS new_registrations_count FROM s_users GROUP BY 1"""
VIEWS["d_active"] = "SELECT event_date AS metric_date, count(DISTINCT user_id) AS dau_count FROM s_events GROUP BY 1"
VIEWS["d_users"] = "SELECT DISTINCT event_date, user_id FROM s_events"
VIEWS["cal"] = "SELECT registration_date AS metric_date FROM s_users UNION SELECT event_date FROM s_events"
VIEWS["d_rolling"] = """
SELECT metric_date,
  (SELECT count(DISTINCT a.user_id) FROM d_users a
    WHERE a.event_date <= cal.metric_date AND a.event_date > cal.metric_date - 7) AS wau_count,
  (SELECT count(DISTINCT a.user_id) FROM d_users a
    WHERE a.event_date <= cal.metric_date AND a.event_date > cal.metric_date - 30) AS mau_count
FROM cal"""
VIEWS["e_totals"] = """
SELECT event_name, count(*) AS total_events, count(DISTINCT user_id) AS unique_users_count,
  count(DISTINCT session_id) AS unique_sessions_count, min(created_at) AS first_event_seen_at,
  max(created_at) AS last_event_seen_at
FROM s_events GROUP BY event_name"""


def daily_revenue(source: str) -> str:
    return f"""
SELECT transaction_date AS metric_date, currency, payment_method, count(*) AS total_transactions_count,
  count(*) FILTER (WHERE is_successful = 1) AS daily_successful_transactions,
  count(*) FILTER (WHERE is_successful = 0) AS daily_failed_transactions,
  count(DISTINCT user_id) FILTER (WHERE is_successful = 1) AS daily_paying_users_count, {PAID} AS daily_gross_revenue
FROM {source} GROUP BY 1, 2, 3"""


VIEWS["d_revenue"] = daily_revenue("s_tx")
VIEWS["d_orders"] = daily_revenue("s_orders")
VIEWS["p_events"] = platform_events("s_events")
VIEWS["p_new"] = """
SELECT registration_date AS metric_date, platform, count(DISTINCT user_id) AS registrations_count
FROM s_users GROUP BY 1, 2"""
VIEWS["p_tx"] = f"""
SELECT t.transaction_date AS metric_date, u.platform, count(*) AS transactions_count, {PAID} AS revenue_amount
FROM s_tx t LEFT JOIN s_users u ON u.user_id = t.user_id GROUP BY 1, 2"""
VIEWS["p_cal"] = """
SELECT metric_date, platform FROM p_events UNION SELECT metric_date, platform FROM p_new
UNION SELECT metric_date, platform FROM p_tx"""
for _name, _view in {
    "user_events_summary": "u_events",
    "user_transactions_summary": "u_tx",
    "daily_new_users": "d_new",
    "dau": "d_active",
    "user_days": "d_users",
    "calendar_dates": "cal",
    "wau_mau": "d_rolling",
    "event_totals": "e_totals",
    "daily_revenue": "d_revenue",
    "platform_events": "p_events",
    "platform_registrations": "p_new",
    "platform_transactions": "p_tx",
    "calendar_platforms": "p_cal",
}.items():
    ORACLE[_name] = f"SELECT * FROM {_view}"

# Models

VIEWS["m_journey"] = f"""
SELECT u.user_id, email, user_role, user_status, platform AS registration_platform, country_code,
  created_at AS registered_at, registration_date,
  coalesce(total_events_count, 0) AS total_events_count, coalesce(total_active_days, 0) AS total_active_days,
  coalesce(total_sessions_count, 0) AS total_sessions_count,
  first_event_at, last_event_at, first_event_date, last_event_date,
  coalesce(total_transactions_count, 0) AS total_transactions_count,
  coalesce(successful_transactions_count, 0) AS successful_transactions_count,
  {MONEY.format("coalesce(lifetime_value_amount, 0)")} AS lifetime_value_amount,
  first_transaction_at, last_transaction_at, first_transaction_date, last_transaction_date,
  CAST(first_event_at IS NOT NULL AS INTEGER) AS has_performed_event,
  CAST(coalesce(successful_transactions_count, 0) > 0 AS INTEGER) AS has_converted_paying,
  CAST(date_diff('day', registration_date, first_transaction_date) AS INTEGER) AS days_to_first_transaction
FROM s_users u LEFT JOIN u_events e ON e.user_id = u.user_id LEFT JOIN u_tx t ON t.user_id = u.user_id"""
VIEWS["m_growth"] = """
SELECT c.metric_date, coalesce(dau_count, 0) AS dau_count, coalesce(wau_count, 0) AS wau_count,
  coalesce(mau_count, 0) AS mau_count, coalesce(new_registrations_count, 0) AS new_registrations_count,
  CAST(sum(coalesce(new_registrations_count, 0)) OVER (ORDER BY c.metric_date NULLS LAST ROWS UNBOUNDED PRECEDING)
    AS BIGINT) AS cumulative_total_users,
  CASE WHEN mau_count > 0 THEN round(CAST(coalesce(dau_count, 0) AS DOUBLE) / CAST(mau_count AS DOUBLE), 4)
    ELSE 0.0 END AS dau_to_mau_stickiness_ratio
FROM cal c LEFT JOIN d_new n ON n.metric_date = c.metric_date LEFT JOIN d_active a ON a.metric_date = c.metric_date
  LEFT JOIN d_rolling r ON r.metric_date = c.metric_date"""
VIEWS["m_funnel_base"] = """
SELECT *, dense_rank() OVER (ORDER BY unique_users_count DESC, total_events DESC) AS step,
  lag(unique_users_count) OVER (ORDER BY unique_users_count DESC, total_events DESC, event_name) AS users_before,
  max(unique_users_count) OVER () AS users_at_top
FROM e_totals"""
VIEWS["m_funnel"] = """
SELECT CAST(step AS BIGINT) AS funnel_step_order, 'Step ' || step || ': ' || event_name AS step_name, event_name,
  total_events, unique_users_count, unique_sessions_count,
  CASE WHEN coalesce(users_before, 0) = 0 THEN 1.0
    ELSE round(CAST(unique_users_count AS DOUBLE) / CAST(users_before AS DOUBLE), 4) END AS step_conversion_rate,
  CASE WHEN users_at_top = 0 THEN 1.0
    ELSE round(CAST(unique_users_count AS DOUBLE) / CAST(users_at_top AS DOUBLE), 4) END AS overall_conversion_rate,
  CASE WHEN users_before > unique_users_count THEN users_before - unique_users_count ELSE 0 END AS step_dropoff_users_count
FROM m_funnel_base"""


def revenue_model(source: str) -> str:
    return f"""
SELECT metric_date, currency, payment_method, total_transactions_count, daily_successful_transactions,
  daily_failed_transactions, daily_paying_users_count, daily_gross_revenue,
  CASE WHEN daily_successful_transactions > 0
    THEN round(CAST(daily_gross_revenue AS DOUBLE) / CAST(daily_successful_transactions AS DOUBLE), 2)
    ELSE 0.0 END AS daily_average_order_value,
  {MONEY.format('''sum(daily_gross_revenue) OVER (PARTITION BY currency, payment_method
    ORDER BY metric_date NULLS LAST ROWS UNBOUNDED PRECEDING)''')} AS cumulative_total_revenue
FROM {source}"""


VIEWS["m_revenue"] = revenue_model("d_revenue")
VIEWS["m_orders"] = revenue_model("d_orders")


def platform_model(equals: str) -> str:
    on = f"{{0}}.metric_date {equals} c.metric_date AND {{0}}.platform {equals} c.platform"
    return f"""
SELECT *, CASE WHEN sum(events_count) OVER (PARTITION BY metric_date) > 0
    THEN round(CAST(events_count AS DOUBLE) / CAST(sum(events_count) OVER (PARTITION BY metric_date) AS DOUBLE), 4)
    ELSE 0.0 END AS platform_event_share_ratio
FROM (SELECT c.metric_date, c.platform, coalesce(e.active_users_count, 0) AS active_users_count,
    coalesce(e.events_count, 0) AS events_count, coalesce(e.sessions_count, 0) AS sessions_count,
    coalesce(n.registrations_count, 0) AS registrations_count, coalesce(t.transactions_count, 0) AS transactions_count,
    {MONEY.format("coalesce(t.revenue_amount, 0)")} AS revenue_amount
  FROM p_cal c LEFT JOIN p_events e ON {on.format("e")} LEFT JOIN p_new n ON {on.format("n")}
    LEFT JOIN p_tx t ON {on.format("t")})"""


VIEWS["m_platform"] = platform_model("=")
ORACLE["mart_platform_split_null_safe"] = platform_model("IS NOT DISTINCT FROM")
for _name, _view in {
    "int_user_journey": "m_journey",
    "mart_user_growth": "m_growth",
    "mart_user_growth_from_rollup": "m_growth",
    "mart_event_funnel": "m_funnel",
    "mart_event_funnel_from_rollup": "m_funnel",
    "mart_revenue": "m_revenue",
    "materialize_mart": "m_revenue",
    "mart_revenue_orders": "m_orders",
    "mart_platform_split": "m_platform",
}.items():
    ORACLE[_name] = f"SELECT * FROM {_view}"

# Summaries

SINCE = "created_at >= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 10 DAY"


def summary(source: str, platform: str) -> str:
    return f"""
SELECT 'total_events' AS section, CAST(NULL AS VARCHAR) AS name, count(*) AS total FROM {source} WHERE {SINCE}
UNION ALL SELECT 'unique_users', NULL, count(DISTINCT user_id) FROM {source} WHERE {SINCE}
UNION ALL (SELECT 'top_events', event_name, count(*) FROM {source} WHERE {SINCE} GROUP BY event_name
  ORDER BY count(*) DESC, event_name LIMIT 10)
UNION ALL SELECT 'platforms', {platform}, count(*) FROM {source} WHERE {SINCE} GROUP BY {platform}"""


ORACLE["event_metrics_summary"] = summary("s_events", "platform")
ORACLE["event_metrics_summary_raw"] = summary("v_raw_events", "coalesce(nullif(platform, ''), 'unknown')")
ORACLE["event_metrics_totals"] = f"""
SELECT count(*) AS total_events, count(DISTINCT user_id) AS unique_users FROM s_events WHERE {SINCE}"""
ORACLE["event_metrics_platforms"] = f"SELECT platform, count(*) AS total FROM v_raw_events WHERE {SINCE} GROUP BY platform"
ORACLE["top_events"] = """
SELECT event_name, count(*) AS total FROM s_events GROUP BY event_name ORDER BY total DESC, event_name LIMIT 10"""

# Data quality

ORACLE["dq_not_null"] = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS failures FROM v_raw_tx"
    for c in ["id", "user_id", "currency", "status", "payment_method", "amount"]
)
ORACLE["dq_unique"] = """
SELECT user_id AS value, count(*) AS occurrences FROM s_tx WHERE user_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1"""
DECLARED = {
    "raw_users": ("v_raw_users", "id created_at", "id"),
    "raw_analytics_events": ("v_raw_events", "id event_name created_at", "id"),
    "raw_transactions": ("v_raw_tx", "id amount created_at", "id"),
    "stg_users": ("s_users", "user_id registration_date", "user_id"),
    "stg_events": ("s_events", "event_id event_name event_date", "event_id"),
    "stg_transactions": ("s_tx", "transaction_id amount transaction_date", "transaction_id"),
    "int_user_journey": ("m_journey", "user_id registered_at has_performed_event has_converted_paying", "user_id"),
    "mart_user_growth": ("m_growth", "metric_date dau_count mau_count", "metric_date"),
    "mart_event_funnel": ("m_funnel", "funnel_step_order event_name unique_users_count", "funnel_step_order"),
    "mart_revenue": ("m_revenue", "metric_date daily_gross_revenue", ""),
    "mart_platform_split": ("m_platform", "metric_date platform active_users_count", ""),
}


def _declared() -> str:
    parts = []
    for model, (view, filled, unique) in DECLARED.items():
        for c in filled.split():
            parts.append(
                f"SELECT '{model}' AS model, '{c}' AS \"column\", 'not_null' AS test, "
                f"count(*) FILTER (WHERE {c} IS NULL) AS failures FROM {view}"
            )
        for c in unique.split():
            parts.append(
                f"SELECT '{model}', '{c}', 'unique', count(*) FROM "
                f"(SELECT {c} FROM {view} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)"
            )
    return "\nUNION ALL ".join(parts)


ORACLE["dq_report"] = _declared()

# Latest rows and samples

ORACLE["latest_growth"] = "SELECT * FROM m_growth ORDER BY metric_date DESC NULLS LAST LIMIT 1"
ORACLE["latest_slice"] = "SELECT * FROM m_revenue WHERE metric_date = (SELECT max(metric_date) FROM m_revenue)"
VIEWS["f_ends"] = """
SELECT arg_min(event_name, rn) AS first_event_name, arg_min(unique_users_count, rn) AS first_users_count,
  arg_max(event_name, rn) AS last_event_name, arg_max(unique_users_count, rn) AS last_users_count,
  arg_max(overall_conversion_rate, rn) AS last_overall_conversion_rate
FROM (SELECT *, row_number() OVER (ORDER BY funnel_step_order, event_name) AS rn FROM m_funnel)"""
ORACLE["first_last_step"] = "SELECT * FROM f_ends"

GROWTH = {
    "business_users_dau": "dau_count",
    "business_users_wau": "wau_count",
    "business_users_mau": "mau_count",
    "business_users_new_daily": "new_registrations_count",
    "business_users_total": "cumulative_total_users",
}
REVENUE = {
    "business_revenue_daily_amount": "daily_gross_revenue",
    "business_transactions_daily_count": "daily_successful_transactions",
    "business_revenue_average_order_value": "daily_average_order_value",
    "business_revenue_cumulative_total": "cumulative_total_revenue",
}
FUNNEL = {
    "business_funnel_step_events_total": "total_events",
    "business_funnel_step_unique_users": "unique_users_count",
    "business_funnel_step_conversion_ratio": "step_conversion_rate",
    "business_funnel_overall_conversion_ratio": "overall_conversion_rate",
}
PLATFORM = {
    "business_platform_active_users": "active_users_count",
    "business_platform_events_total": "events_count",
    "business_platform_revenue_total": "revenue_amount",
}
SRC = 'source="business_pipeline"'


def samples(source: str, metrics: dict[str, str], labels: str, section: int, ts: str, order: str) -> str:
    return "\nUNION ALL ".join(
        f"""SELECT '{metric}' AS metric, {labels} AS labels, CAST(coalesce({column}, 0) AS DOUBLE) AS value,
  CAST({ts} AS BIGINT) AS ts_ms, {section} AS section, {order}, {item} AS item FROM {source}"""
        for item, (metric, column) in enumerate(metrics.items())
    )


HISTORY_TS = "date_diff('day', DATE '1970-01-01', metric_date) * 86400000"
REVENUE_LABELS = (
    "'currency=\"' || coalesce(nullif(currency, ''), 'USD') || '\",payment_method=\"' || "
    f"coalesce(nullif(payment_method, ''), 'all') || '\",{SRC}'"
)
REVENUE_ORDER = "CAST(0 AS BIGINT) AS step, currency AS first, payment_method AS second"
FUNNEL_LABELS = (
    "'event_name=\"' || event_name || '\"," + SRC + ",step_name=\"' || step_name || '\",step_order=\"' || "
    "funnel_step_order || '\"'"
)
PLATFORM_LABELS = f"'platform=\"' || coalesce(nullif(platform, ''), 'unknown') || '\",{SRC}'"
PLATFORM_ORDER = "CAST(0 AS BIGINT) AS step, coalesce(nullif(platform, ''), 'unknown') AS first, '' AS second"
NO_ORDER = "CAST(0 AS BIGINT) AS step, '' AS first, '' AS second"
LATEST = "(SELECT * FROM {0} WHERE metric_date = (SELECT max(metric_date) FROM {0}))"
DATED = "(SELECT * FROM {0} WHERE metric_date IS NOT NULL)"

VIEWS["x_growth"] = samples(LATEST.format("m_growth"), GROWTH, f"'{SRC}'", 1, str(TS_MS), NO_ORDER)
VIEWS["x_revenue"] = samples(LATEST.format("m_revenue"), REVENUE, REVENUE_LABELS, 2, str(TS_MS), REVENUE_ORDER)
VIEWS["x_funnel"] = samples(
    "m_funnel", FUNNEL, FUNNEL_LABELS, 3, str(TS_MS), "funnel_step_order AS step, event_name AS first, '' AS second"
)
VIEWS["x_platform"] = samples(LATEST.format("m_platform"), PLATFORM, PLATFORM_LABELS, 4, str(TS_MS), PLATFORM_ORDER)
VIEWS["x_all"] = "\nUNION ALL ".join(
    f"SELECT * FROM {v}" for v in ["x_growth", "x_revenue", "x_funnel", "x_platform"]
)
VIEWS["h_growth"] = samples(DATED.format("m_growth"), GROWTH, f"'{SRC}'", 1, HISTORY_TS, NO_ORDER)
VIEWS["h_revenue"] = samples(
    DATED.format("m_revenue"), REVENUE, REVENUE_LABELS, 2, HISTORY_TS, "currency, payment_method"
)
VIEWS["h_platform"] = samples(DATED.format("m_platform"), PLATFORM, PLATFORM_LABELS, 4, HISTORY_TS, "platform")
for _name, _view in {
    "metrics_user_growth": "x_growth",
    "metrics_revenue": "x_revenue",
    "metrics_funnel": "x_funnel",
    "metrics_platform": "x_platform",
    "metric_samples": "x_all",
}.items():
    ORACLE[_name] = f"SELECT * FROM {_view}"

HEADER = """
SELECT section, step, first, second, item, {0} AS line_in_sample, '# {1} ' || metric || ' {2}' AS line
FROM {3} QUALIFY row_number() OVER (PARTITION BY metric ORDER BY section, step, first, second, item) = 1"""


def exposition(source: str) -> str:
    return f"""
SELECT section, step, first, second, item, 2 AS line_in_sample,
  metric || '{{' || labels || '}} ' || CAST(value AS VARCHAR) || ' ' || ts_ms AS line FROM {source}
UNION ALL {HEADER.format(0, "HELP", "Business flow telemetry metric", source)}
UNION ALL {HEADER.format(1, "TYPE", "gauge", source)}"""


ORACLE["metrics_exposition"] = exposition("x_all")
ORACLE["write_text"] = f"SELECT line FROM ({exposition('x_funnel')})"

# Queries on samples

ORACLE["metric_instant"] = """
SELECT labels AS series, value, ts_ms FROM h_platform WHERE metric = 'business_platform_active_users'
QUALIFY row_number() OVER (PARTITION BY labels ORDER BY ts_ms DESC) = 1"""
ORACLE["metric_instant_matched"] = f"""
SELECT labels AS series, value, ts_ms FROM h_platform
WHERE metric = 'business_platform_events_total' AND platform = 'ios' AND ts_ms <= {TS_MS - 10 * DAY_MS}
QUALIFY row_number() OVER (PARTITION BY labels ORDER BY ts_ms DESC) = 1"""
ORACLE["metric_sum"] = """
SELECT ts_ms, round(sum(value), 6) AS value FROM h_revenue WHERE metric = 'business_revenue_cumulative_total' GROUP BY 1"""
ORACLE["metric_avg_positive"] = """
SELECT ts_ms, round(avg(value), 6) AS value FROM h_revenue
WHERE metric = 'business_revenue_average_order_value' AND value > 0 GROUP BY 1"""
ORACLE["metric_max"] = """
SELECT ts_ms, max(value) AS value FROM x_funnel
WHERE metric = 'business_funnel_step_unique_users' AND step = 1 GROUP BY 1"""
ORACLE["metric_sum_by"] = """
SELECT ts_ms, payment_method, round(sum(value), 6) AS value FROM h_revenue
WHERE metric = 'business_revenue_cumulative_total' GROUP BY 1, 2"""
ORACLE["metric_scale"] = """
SELECT labels AS series, value * 100 AS value, ts_ms FROM x_funnel
WHERE metric = 'business_funnel_overall_conversion_ratio'"""
ORACLE["metric_stickiness"] = """
SELECT d.labels AS series, d.ts_ms, d.value / m.value * 100 AS value FROM h_growth d, h_growth m
WHERE d.metric = 'business_users_dau' AND m.metric = 'business_users_mau' AND d.ts_ms = m.ts_ms
  AND d.labels = m.labels AND m.value > 0"""
ORACLE["metric_range"] = f"""
SELECT payment_method || ' (' || currency || ')' AS legend, labels AS series, ts_ms, value FROM h_revenue
WHERE metric = 'business_revenue_daily_amount' AND ts_ms BETWEEN {TS_MS - 20 * DAY_MS} AND {TS_MS}"""
ORACLE["metric_reduce"] = """
SELECT labels AS series, round(arg_max(value, ts_ms), 6) AS last_not_null, round(max(value), 6) AS "max",
  round(sum(value), 6) AS "sum", round(avg(value), 6) AS mean
FROM h_platform WHERE metric = 'business_platform_revenue_total' GROUP BY labels"""
ORACLE["metric_stack"] = """
SELECT ts_ms, labels AS series, value,
  round(sum(value) OVER (PARTITION BY ts_ms ORDER BY labels ROWS UNBOUNDED PRECEDING), 6) AS stacked
FROM h_revenue WHERE metric = 'business_revenue_daily_amount'"""
ORACLE["bottomk"] = """
SELECT labels AS series, ts_ms, value FROM h_platform WHERE metric = 'business_platform_active_users'
QUALIFY row_number() OVER (PARTITION BY ts_ms ORDER BY value, labels) = 1"""
ORACLE["bottomk_funnel"] = """
SELECT labels AS series, ts_ms, value * 100 AS value FROM x_funnel WHERE metric = 'business_funnel_overall_conversion_ratio'
QUALIFY row_number() OVER (PARTITION BY ts_ms ORDER BY value, labels) = 1"""

# Report numbers

VIEWS["k_growth"] = f"""
SELECT cumulative_total_users AS total_users, dau_count AS current_dau, wau_count AS current_wau,
  mau_count AS current_mau, new_registrations_count AS new_today, {exact1("dau_to_mau_stickiness_ratio * 100")} AS stickiness_pct
FROM m_growth WHERE metric_date = (SELECT max(metric_date) FROM m_growth)"""
VIEWS["k_funnel"] = f"""
SELECT first_users_count AS funnel_top_users, last_users_count AS funnel_bottom_users,
  {exact1("last_overall_conversion_rate * 100")} AS overall_funnel_pct
FROM f_ends"""


def revenue_kpis(source: str) -> str:
    return f"""
SELECT total_gross_revenue, total_transactions, successful_transactions,
  CASE WHEN successful_transactions > 0 THEN {exact2("total_gross_revenue / successful_transactions")} ELSE 0.0 END
    AS avg_order_value,
  (SELECT currency FROM {source} ORDER BY metric_date DESC NULLS FIRST, currency DESC, payment_method DESC LIMIT 1) AS currency,
  true_total_revenue
FROM (SELECT {exact2("CAST(max(cumulative_total_revenue) AS DOUBLE)")} AS total_gross_revenue,
    CAST(sum(total_transactions_count) AS BIGINT) AS total_transactions,
    CAST(sum(daily_successful_transactions) AS BIGINT) AS successful_transactions,
    {exact2("CAST(sum(daily_gross_revenue) AS DOUBLE)")} AS true_total_revenue
  FROM {source})"""


def band(value: str, low: float, high: float) -> str:
    return f"CASE WHEN {value} < {low} THEN 'red' WHEN {value} < {high} THEN 'amber' ELSE 'green' END"


VIEWS["k_revenue"] = revenue_kpis("m_revenue")
ORACLE["kpi_latest_growth"] = "SELECT * FROM k_growth"
ORACLE["kpi_funnel"] = "SELECT * FROM k_funnel"
ORACLE["kpi_revenue"] = "SELECT * FROM k_revenue"
ORACLE["kpi_revenue_orders"] = revenue_kpis("m_orders")
ORACLE["dashboard_kpis"] = f"""
SELECT total_users, current_dau, current_wau, current_mau, stickiness_pct,
  {band("stickiness_pct", 15, 30)} AS stickiness_band, funnel_top_users, funnel_bottom_users, overall_funnel_pct,
  {band("overall_funnel_pct", 40, 60)} AS funnel_band, total_gross_revenue, total_transactions,
  successful_transactions, avg_order_value, currency
FROM k_growth, k_funnel, k_revenue"""
ORACLE["growth_series"] = "SELECT * REPLACE (CAST(metric_date AS VARCHAR) AS metric_date) FROM m_growth"
ORACLE["funnel_series"] = "SELECT * FROM m_funnel"
ORACLE["revenue_series"] = """
SELECT * REPLACE (CAST(metric_date AS VARCHAR) AS metric_date, CAST(daily_gross_revenue AS DOUBLE) AS daily_gross_revenue,
  CAST(cumulative_total_revenue AS DOUBLE) AS cumulative_total_revenue) FROM m_revenue"""
ORACLE["platform_series"] = """
SELECT * REPLACE (CAST(metric_date AS VARCHAR) AS metric_date, coalesce(platform, 'unknown') AS platform,
  CAST(revenue_amount AS DOUBLE) AS revenue_amount) FROM m_platform"""
VIEWS["k_platform"] = f"""
SELECT coalesce(platform, 'unknown') AS platform, CAST(sum(events_count) AS BIGINT) AS events,
  CAST(sum(active_users_count) AS BIGINT) AS users, {MONEY.format("sum(revenue_amount)")} AS revenue
FROM m_platform GROUP BY 1"""
ORACLE["kpi_platform_totals"] = "SELECT * FROM k_platform"
VIEWS["k_by_date"] = f"""
SELECT metric_date, {MONEY.format("sum(daily_gross_revenue)")} AS gross_revenue,
  {MONEY.format("max(cumulative_total_revenue)")} AS max_cumulative_revenue
FROM m_revenue GROUP BY 1"""
ORACLE["revenue_by_date"] = "SELECT * FROM k_by_date"
for _metric in ["users", "events", "revenue"]:
    ORACLE[f"platform_share_{_metric}"] = f"""
SELECT platform, value, CASE WHEN total > 0 THEN {exact1_up("(value / total * 100)")} ELSE 0.0 END AS share_pct
FROM (SELECT p.platform, CAST(coalesce(k.{_metric}, 0) AS DOUBLE) AS value,
    CAST(sum(coalesce(k.{_metric}, 0)) OVER () AS DOUBLE) AS total
  FROM (VALUES ('ios'), ('android'), ('web')) p(platform) LEFT JOIN k_platform k ON k.platform = p.platform)"""
ORACLE["funnel_table_format"] = f"""
SELECT '#' || funnel_step_order AS step, coalesce(nullif(step_name, ''), event_name) AS label, event_name,
  unique_users_count, total_events, format('{{:.1f}}', {exact1_up("(step_conversion_rate * 100)")}) AS step_rate,
  CASE WHEN {exact1_up("(step_conversion_rate * 100)")} >= 80 THEN 'positive' ELSE 'neutral' END AS tag,
  format('{{:.1f}}', {exact1_up("(overall_conversion_rate * 100)")}) AS overall_rate,
  CASE WHEN step_dropoff_users_count > 0 THEN '-' || step_dropoff_users_count ELSE '0' END AS dropoff
FROM m_funnel"""
ORACLE["threshold_band"] = f"""
SELECT metric_date, {band(exact1("dau_to_mau_stickiness_ratio * 100"), 15, 30)} AS stickiness_band FROM m_growth"""


def json_fields(section: str, key: str, rows: str) -> str:
    return f"""
SELECT '{section}' AS section, sort_key, j.key AS field, TRY_CAST(json_extract_string(j.value, '$') AS DOUBLE) AS number,
  CASE WHEN TRY_CAST(json_extract_string(j.value, '$') AS DOUBLE) IS NULL THEN json_extract_string(j.value, '$') END AS text
FROM (SELECT {key} AS sort_key, to_json(t) AS line FROM ({rows}) t) l, json_each(l.line) j"""


REPORT_LINES = {
    "user_growth": ("t.metric_date", ORACLE["growth_series"]),
    "event_funnel": ("lpad(CAST(t.funnel_step_order AS VARCHAR), 12, '0') || '|' || t.event_name", ORACLE["funnel_series"]),
    "revenue": ("t.metric_date || '|' || t.currency || '|' || t.payment_method", ORACLE["revenue_series"]),
    "platform_split": ("t.metric_date || '|' || t.platform", ORACLE["platform_series"]),
    "platform_totals": ("t.platform", "SELECT * REPLACE (CAST(revenue AS DOUBLE) AS revenue) FROM k_platform"),
}
ORACLE["dashboard_json"] = " UNION ALL ".join(json_fields(name, *line) for name, line in REPORT_LINES.items())
ORACLE["daily_dashboard"] = f"SELECT section, field, number, text, count(*) AS n_lines FROM ({ORACLE['dashboard_json']}) GROUP BY ALL"
ORACLE["mart_orderings"] = " UNION ALL ".join(
    f"SELECT '{mart}' AS mart, row_number() OVER (ORDER BY {order}) AS position, {key} AS key FROM {view}"
    for mart, view, order, key in (
        ("mart_user_growth", "m_growth", "metric_date ASC NULLS LAST", "coalesce(CAST(metric_date AS VARCHAR), '-')"),
        ("mart_event_funnel", "m_funnel", "funnel_step_order, event_name", "event_name"),
        (
            "mart_revenue", "m_revenue", "metric_date DESC NULLS LAST, currency, payment_method",
            "coalesce(CAST(metric_date AS VARCHAR), '-') || '|' || currency || '|' || payment_method",
        ),
        ("mart_platform_split", "m_platform", "metric_date DESC NULLS LAST, platform NULLS LAST", "coalesce(CAST(metric_date AS VARCHAR), '-') || '|' || coalesce(platform, '-')"),
    )
)
ORACLE["extract_tables"] = """
SELECT 0 AS position, 'users' AS table_name, count(*) AS row_count FROM v_raw_users
UNION ALL SELECT 1, 'analytics_events', count(*) FROM v_raw_events
UNION ALL SELECT 2, 'transactions', count(*) FROM v_raw_tx"""
ORACLE["daily_report"] = ORACLE["dq_report"]
ORACLE["daily_samples"] = f"SELECT line, CAST(1 AS INTEGER) AS times FROM ({ORACLE['metrics_exposition']})"

# Posted events

def posted(single: str) -> str:
    """Events as posted; where ``single`` holds, alone."""
    return f"""
SELECT *, CASE WHEN single THEN 'e' || event_id ELSE 'b' || batch_no END AS batch_id,
  CASE WHEN single THEN 'event' ELSE 'batch' END AS endpoint,
  row_number() OVER (PARTITION BY single, batch_no ORDER BY event_id) - 1 AS pos,
  max(ts) OVER (PARTITION BY single, batch_no) + INTERVAL 1 HOUR AS arrival_ts,
  single AND event_id % 35 = 0 AS broken,
  CASE WHEN event_id % 29 <> 0 THEN CASE WHEN event_id % 23 = 0 THEN '' ELSE event_type END END AS event_name,
  CASE WHEN event_id % 11 <> 0 THEN CASE WHEN event_id % 7 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END END AS posted_user,
  CASE WHEN event_id % 101 = 0 THEN repeat('x', 60) ELSE 'Android' END AS platform,
  CASE WHEN event_id % 113 = 0 THEN '[1]' ELSE replace(props, ': ', ':') END AS properties,
  CASE WHEN event_id % 37 <> 0 AND event_id % 31 <> 0 THEN ts END AS event_time,
  event_id % 37 <> 0 AND event_id % 31 = 0 AS bad_time,
  CASE WHEN batch_no % 2 = 0 THEN 'auth-' || batch_no END AS auth_user,
  CASE WHEN batch_no % 3 = 0 THEN '10.0.0.' || (batch_no % 250) ELSE '192.168.0.9' END AS ip
FROM (SELECT *, {single} AS single, CASE WHEN {single} THEN event_id ELSE event_id // 25 END AS batch_no FROM events)"""


def checked(source: str) -> str:
    return f"""
SELECT *, concat_ws(',', CASE WHEN coalesce(event_name, '') = '' THEN 'event_name_required' END,
  CASE WHEN length(platform) > 50 THEN 'platform_length' END,
  CASE WHEN properties = '[1]' THEN 'properties_not_object' END,
  CASE WHEN bad_time THEN 'occurred_at_not_date' END) AS errors
FROM {source} WHERE NOT broken"""


VIEWS["i_posted"] = posted("event_id % 5 = 0")
VIEWS["i_checked"] = checked("i_posted")


def stored(source: str, user: str, extra: str = "TRUE") -> str:
    return f"""
SELECT sha256(batch_id || ':' || pos) AS id, event_name, CAST(NULL AS VARCHAR) AS event_category, {user} AS user_id,
  CAST(NULL AS VARCHAR) AS session_id, platform, CAST(NULL AS VARCHAR) AS app_version, CAST(NULL AS VARCHAR) AS os_version,
  CAST(NULL AS VARCHAR) AS device_model, properties, ip AS ip_address, 'sdk/1.0' AS user_agent,
  coalesce(event_time, arrival_ts) AS occurred_at, arrival_ts AS created_at, arrival_ts AS updated_at
FROM {source} WHERE {extra}"""


BLANK_USER = "coalesce(nullif(posted_user, ''), auth_user)"
NAMED = "coalesce(event_name, '') <> ''"
CLEAN = "batch_id NOT IN (SELECT batch_id FROM i_checked WHERE errors <> '')"
BROKEN = "SELECT batch_id, endpoint, CAST(NULL AS INTEGER) AS pos, 'invalid_json' AS errors FROM i_posted WHERE broken"
ORACLE["ingest_parse"] = "SELECT DISTINCT batch_id, endpoint, NOT broken AS readable FROM i_posted"
ORACLE["ingest_explode_batch"] = "SELECT batch_id, endpoint, CAST(pos AS INTEGER) AS pos, event_name FROM i_checked"
ORACLE["ingest_validate"] = "SELECT batch_id, CAST(pos AS INTEGER) AS pos, errors FROM i_checked"
ORACLE["event_id"] = "SELECT batch_id, CAST(pos AS INTEGER) AS pos, sha256(batch_id || ':' || pos) AS id FROM i_checked"
ORACLE["ingest_enrich"] = stored("i_checked", "coalesce(posted_user, auth_user)")
ORACLE["ingest_batch_policy_atomic"] = stored("i_checked", BLANK_USER, CLEAN)
ORACLE["ingest_batch_policy_lenient"] = stored("i_checked", BLANK_USER, NAMED)
ORACLE["ingest_stream"] = stored("i_checked", BLANK_USER, NAMED)
VIEWS["i_raw"] = f"SELECT *, properties AS properties_json FROM ({stored('i_checked', BLANK_USER, NAMED)})"
ORACLE["ingest_quarantine_lenient"] = f"""
{BROKEN} UNION ALL SELECT batch_id, endpoint, CAST(pos AS INTEGER), 'event_name_required' FROM i_checked WHERE NOT ({NAMED})"""
ORACLE["ingest_quarantine_atomic"] = f"""
{BROKEN} UNION ALL
SELECT batch_id, endpoint, NULL, string_agg(pos || ':' || replace(errors, ',', ',' || pos || ':'), ',' ORDER BY pos)
FROM i_checked WHERE errors <> '' GROUP BY batch_id, endpoint"""
ORACLE["merge_properties"] = """
SELECT event_id, 'k="' || regexp_extract(props, '[0-9]+') || '",kind="' || event_type || '"' AS merged FROM events"""
VIEWS["i_sdk"] = "SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k FROM events"
ORACLE["typed_event_properties"] = """
SELECT CAST(event_id AS VARCHAR) AS event_id,
  CASE event_type WHEN 'view' THEN 'screen_view' WHEN 'click' THEN 'button_tap' WHEN 'purchase' THEN 'purchase_completed'
    WHEN 'error' THEN 'app_open' ELSE event_type END AS event_name,
  CASE event_type WHEN 'view' THEN 'navigation' WHEN 'click' THEN 'interaction' WHEN 'error' THEN 'system'
    ELSE 'conversion' END AS event_category,
  CASE WHEN event_type IN ('view', 'click') THEN 'screen_' || k END AS screen_name,
  CASE WHEN event_type = 'view' AND k % 2 = 0 THEN 'home' END AS previous_screen,
  CASE WHEN event_type = 'click' THEN 'btn_' || k END AS button_id,
  CASE WHEN event_type IN ('signup', 'purchase') THEN value END AS value,
  CASE WHEN event_type = 'signup' THEN 'BRL' WHEN event_type = 'purchase' AND k % 3 = 0 THEN 'EUR'
    WHEN event_type = 'purchase' THEN 'USD' END AS currency,
  CASE WHEN event_type = 'purchase' THEN 'ord-' || event_id END AS order_id,
  CASE WHEN event_type = 'purchase' AND k % 2 = 0 THEN 'pix' END AS payment_method,
  CASE WHEN event_type = 'purchase' THEN k % 4 END AS item_count
FROM i_sdk"""
ORACLE["purchase_items"] = """
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(i - 1 AS INTEGER) AS item_no, 'sku-' || i AS sku, CAST(i AS VARCHAR) AS qty
FROM i_sdk, range(1, 4) r(i) WHERE event_type = 'purchase' AND i <= k % 4"""

ORACLE = {name: with_views(sql) for name, sql in ORACLE.items()}
ORACLE["ingest_to_growth"] = with_views("SELECT * FROM m_growth", events=staged_events("i_raw"))
