"""DuckDB SQL for the registered queries, written from the definitions."""

from __future__ import annotations

from collections.abc import Callable

RAW_SQL = """
keyed AS (
  SELECT *, event_id AS n, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS iso
  FROM events),
once AS (
  SELECT n,
    CAST(n AS VARCHAR) AS event_id,
    CASE WHEN n % 100 = 99 THEN 'abc' WHEN n % 100 = 49 THEN NULL
         ELSE CAST(user_id AS VARCHAR) END AS user_id,
    CASE WHEN k % 20 = 19 THEN 'unknown' WHEN event_type = 'view' THEN 'page_view'
         WHEN event_type = 'signup' THEN 'login' WHEN event_type = 'click' THEN 'add_to_cart'
         WHEN event_type = 'purchase' THEN 'checkout' WHEN event_type = 'error' THEN 'error'
    END AS event_type,
    CASE WHEN n % 40 = 39 THEN NULL WHEN n % 40 = 17 THEN 'not-a-time'
         WHEN n % 40 = 7 THEN iso || '-05:00' ELSE iso || '+00:00' END AS event_timestamp,
    CASE k % 7 WHEN 0 THEN '/' WHEN 1 THEN '/home' WHEN 2 THEN '/products' WHEN 3 THEN '/cart'
         WHEN 4 THEN '/checkout' WHEN 5 THEN '/support' ELSE '/admin' END AS page,
    CASE WHEN k % 20 <> 19 AND event_type IN ('click', 'purchase')
         THEN CAST(1000 + k AS BIGINT) END AS product_id,
    CASE WHEN k % 20 <> 19 AND event_type IN ('click', 'purchase') THEN value END AS amount,
    CASE WHEN k % 20 <> 19 AND event_type = 'error'
         THEN CASE k % 3 WHEN 0 THEN '500_INTERNAL' WHEN 1 THEN 'TIMEOUT'
              ELSE 'VALIDATION_ERROR' END END AS error_code,
    'web_app' AS source
  FROM keyed),
raw AS (SELECT * FROM once UNION ALL SELECT * FROM once WHERE n % 25 = 0),
dated AS (
  SELECT *, coalesce(try_cast(substr(event_timestamp, 1, 10) AS DATE), DATE '2024-02-01') AS event_date
  FROM raw)
"""

_TYPED = """
typed AS (
  SELECT * EXCLUDE (user_id), user_id AS user_text, try_cast(user_id AS BIGINT) AS user_id,
    try_cast(substr(event_timestamp, 1, 26) AS TIMESTAMP)
      - to_hours(coalesce(try_cast(substr(event_timestamp, 27, 3) AS INTEGER), 0)) AS event_timestamp_ts
  FROM (SELECT DISTINCT * FROM dated)),
judged AS (
  SELECT *,
    CASE WHEN user_id IS NULL THEN 'bad_user_id'
         WHEN event_type IS NULL OR event_type NOT IN
              ('login', 'page_view', 'add_to_cart', 'checkout', 'error') THEN 'bad_event_type'
         WHEN page IS NULL OR page NOT IN
              ('/', '/home', '/products', '/cart', '/checkout', '/support') THEN 'bad_page'
         WHEN event_timestamp IS NOT NULL AND event_timestamp_ts IS NULL THEN 'bad_event_timestamp'
    END AS reason
  FROM typed),
silver AS (
  SELECT event_id, user_id, event_type, event_timestamp, event_timestamp_ts, event_date, page,
    product_id, amount, error_code, source,
    CAST(event_type = 'checkout' AS INTEGER) AS is_purchase_event,
    CAST(event_type = 'error' AS INTEGER) AS is_error_event,
    CAST(hour(event_timestamp_ts) AS INTEGER) AS event_hour,
    strftime(event_timestamp_ts, '%a') AS event_day_of_week
  FROM judged WHERE reason IS NULL)
"""

_GOLD = """
gold AS (
  SELECT event_date, user_id, count(*) AS events_count,
    count(*) FILTER (event_type = 'page_view') AS page_view_count,
    count(*) FILTER (event_type = 'login') AS login_count,
    count(*) FILTER (event_type = 'add_to_cart') AS add_to_cart_count,
    count(*) FILTER (event_type = 'checkout') AS checkout_count,
    count(*) FILTER (event_type = 'error') AS error_count,
    CAST(sum(is_purchase_event) AS BIGINT) AS purchase_events,
    CAST(sum(is_error_event) AS BIGINT) AS error_events,
    round(sum(amount), 2) AS total_amount,
    min(event_timestamp_ts) AS first_event_ts, max(event_timestamp_ts) AS last_event_ts
  FROM silver GROUP BY event_date, user_id)
"""


_CONFLICTS = """
redelivered AS (
  SELECT * FROM dated UNION ALL
  SELECT * REPLACE (CASE WHEN n % 30 = 7 THEN '/support' ELSE page END AS page,
                    CASE WHEN n % 30 <> 13 THEN event_timestamp END AS event_timestamp,
                    CASE WHEN n % 30 = 19 THEN CAST(event_date + 1 AS DATE) ELSE event_date END AS event_date)
  FROM dated WHERE n % 30 IN (7, 13, 19))
"""

_UNSOUND = """
unsound AS (
  SELECT * FROM gold UNION ALL
  SELECT * FROM gold WHERE user_id % 7 = 5 UNION ALL
  SELECT * REPLACE (CASE WHEN user_id % 14 = 10 THEN 0 ELSE events_count + 1 END AS events_count,
                    purchase_events + 1 AS purchase_events,
                    CASE WHEN user_id % 3 = 0 THEN error_events + 1 END AS error_events,
                    CASE WHEN user_id % 2 = 0 THEN last_event_ts + INTERVAL 1 HOUR END AS first_event_ts,
                    CASE WHEN user_id % 14 <> 3 THEN user_id END AS user_id)
  FROM gold WHERE user_id % 7 = 3)
"""


def _raw(select: str) -> str:
    return f"WITH {RAW_SQL} {select}"


def _silver(select: str) -> str:
    return f"WITH {RAW_SQL}, {_TYPED} {select}"


def _gold(select: str) -> str:
    return f"WITH {RAW_SQL}, {_TYPED}, {_GOLD} {select}"


def _both_golds(select: Callable[[str, str], str]) -> str:
    """`select` of a table's name and the name it gets in the result, for sound and unsound gold."""
    both = _union([select("gold", "'sound' AS gold_table"), select("unsound", "'unsound' AS gold_table")])
    return f"WITH {RAW_SQL}, {_TYPED}, {_GOLD}, {_UNSOUND} {both}"


def _one_of(identity: str) -> str:
    """One row of each identity: the earliest timestamp text, absent ones last, then by the other columns."""
    rest = "user_id, event_type, page, product_id, amount, error_code, source, event_date"
    order = ", ".join(f"{c} NULLS LAST" for c in ["event_timestamp", *rest.split(", ")])
    return (
        f"WITH {RAW_SQL}, {_CONFLICTS} SELECT {_EVENT}, event_date FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY {identity} ORDER BY {order}) AS place FROM redelivered) WHERE place = 1"
    )


_SESSIONS = """
paused AS (
  SELECT *, event_timestamp_ts - lag(event_timestamp_ts) OVER by_user <= INTERVAL 2 DAY AS goes_on FROM silver
  WHERE event_timestamp_ts IS NOT NULL
  WINDOW by_user AS (PARTITION BY user_id ORDER BY event_timestamp_ts, event_id, event_date)),
numbered AS (
  SELECT *, count(*) FILTER (goes_on IS NOT TRUE) OVER (
    PARTITION BY user_id ORDER BY event_timestamp_ts, event_id, event_date ROWS UNBOUNDED PRECEDING) AS place
  FROM paused),
sessions AS (
  SELECT user_id, min(event_timestamp_ts) AS session_start, max(event_timestamp_ts) AS session_end,
    count(*) AS events_count, count(*) FILTER (event_type = 'add_to_cart') AS carts,
    count(*) FILTER (event_type = 'checkout') AS checkouts,
    round(coalesce(sum(amount) FILTER (event_type = 'checkout'), 0), 2) AS revenue
  FROM numbered GROUP BY user_id, place)
"""

_EVENT = "event_id, user_id, event_type, event_timestamp, page, product_id, amount, error_code, source"
_ALL_SILVER = _silver("SELECT * FROM silver")
_ALL_GOLD = _gold("SELECT * FROM gold")
_QUARANTINE = _silver(
    "SELECT event_id, user_text AS user_id, event_type, event_timestamp, page, product_id, amount, "
    "error_code, source, event_date, reason FROM judged WHERE reason IS NOT NULL"
)

_BROKEN = """
broken AS (
  SELECT event_date, CASE n % 97 WHEN 5 THEN 'bad_envelope' WHEN 29 THEN 'bad_envelope'
    WHEN 11 THEN 'empty_message' ELSE 'bad_message' END AS ingest_fault
  FROM dated WHERE n % 97 IN (5, 11, 17, 23, 29))
"""

_NOT_NULL_COLUMNS = (
    "event_date", "user_id", "events_count", "page_view_count", "login_count",
    "add_to_cart_count", "checkout_count", "error_count", "purchase_events", "error_events",
)
_GOLD_TYPES = {
    "event_date": "date",
    **{c: "bigint" for c in _NOT_NULL_COLUMNS[1:]},
    "total_amount": "double",
    "first_event_ts": "timestamp_ntz",
    "last_event_ts": "timestamp_ntz",
}
_INVARIANTS = {
    "events_count_is_sum_of_types": "events_count <> page_view_count + login_count "
    "+ add_to_cart_count + checkout_count + error_count",
    "purchase_events_is_checkout_count": "purchase_events <> checkout_count",
    "error_events_is_error_count": "error_events <> error_count",
    "first_event_not_after_last": "first_event_ts > last_event_ts",
    "first_and_last_event_both_or_neither": "(first_event_ts IS NULL) <> (last_event_ts IS NULL)",
    "at_least_one_event": "events_count < 1",
}

_TYPES = "('login', 'page_view', 'add_to_cart', 'checkout', 'error')"
_DQ_RULES = {
    "event_id_not_null": "event_id IS NULL",
    "user_id_not_null": "user_id IS NULL",
    "user_id_is_integer": "user_id IS NOT NULL AND try_cast(user_id AS BIGINT) IS NULL",
    "event_type_accepted": f"event_type IS NULL OR event_type NOT IN {_TYPES}",
    "page_accepted": "page IS NULL OR page NOT IN "
    "('/', '/home', '/products', '/cart', '/checkout', '/support')",
    "event_timestamp_not_null": "event_timestamp IS NULL",
    "event_timestamp_readable": "event_timestamp = 'not-a-time'",
    "product_id_in_range": "product_id NOT BETWEEN 1000 AND 1100",
    "product_id_only_with_item_events": "(product_id IS NOT NULL) <> "
    "(event_type IN ('add_to_cart', 'checkout'))",
    "amount_is_number": "FALSE",
    "amount_is_finite": "amount IS NOT NULL AND NOT isfinite(amount)",
    "amount_in_range": "amount IS NOT NULL AND amount NOT BETWEEN 5.0 AND 300.0",
    "error_code_accepted": "error_code NOT IN ('500_INTERNAL', 'TIMEOUT', 'VALIDATION_ERROR')",
    "error_code_only_with_errors": "(error_code IS NOT NULL) <> (event_type = 'error')",
}

_RFM = """
WITH customers AS (
  SELECT o_custkey, CAST(max(o_orderdate) AS DATE) AS last_order_date, count(*) AS orders_count,
         round(sum(o_totalprice), 2) AS monetary
  FROM orders GROUP BY o_custkey),
scored AS (
  SELECT *,
    CAST(ntile(5) OVER (ORDER BY last_order_date, o_custkey) AS INTEGER) AS r_score,
    CAST(ntile(5) OVER (ORDER BY orders_count, o_custkey) AS INTEGER) AS f_score,
    CAST(ntile(5) OVER (ORDER BY monetary, o_custkey) AS INTEGER) AS m_score
  FROM customers)
SELECT *, CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'champion'
  WHEN r_score >= 3 AND f_score >= 3 THEN 'loyal'
  WHEN r_score >= 4 THEN 'recent'
  WHEN r_score <= 2 AND f_score >= 3 THEN 'at_risk'
  WHEN r_score <= 2 AND f_score <= 2 THEN 'dormant'
  ELSE 'regular' END AS segment
FROM scored
"""


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


_LOAD_RULES = _union(
    [
        f"SELECT n % 4 AS step, '{name}' AS rule, count(*) FILTER ({rule}) AS failing, count(*) AS total FROM damaged GROUP BY 1"
        for name, rule in {**_DQ_RULES, "message_opened": "FALSE"}.items()
    ]
)
_DRIFT = f"""
WITH {RAW_SQL}, damaged AS (
  SELECT * REPLACE (CASE WHEN n % 12 = 2 THEN '/admin' ELSE page END AS page) FROM dated),
beside AS (
  SELECT *, CAST(coalesce(sum(failing) OVER earlier, 0) AS BIGINT) AS earlier_failing,
    CAST(coalesce(sum(total) OVER earlier, 0) AS BIGINT) AS earlier_total
  FROM ({_LOAD_RULES})
  WINDOW earlier AS (PARTITION BY rule ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
shares AS (
  SELECT *, abs(failing / total - earlier_failing / nullif(earlier_total, 0)) AS gap,
    (failing + earlier_failing) / (total + earlier_total) AS pooled
  FROM beside)
SELECT 'part-' || step AS load_id, rule, failing, total, earlier_failing, earlier_total,
  coalesce(gap > 0.01 AND gap > 4 * sqrt(pooled * (1 - pooled) * (1 / total + 1 / nullif(earlier_total, 0))), FALSE) AS drifted
FROM shares
"""

_BRONZE_COUNTS = (
    f"WITH {RAW_SQL}, {_BROKEN}, "
    "lines AS (SELECT event_date, CAST(NULL AS VARCHAR) AS ingest_fault FROM dated "
    "UNION ALL SELECT DATE '2024-02-01', ingest_fault FROM broken) "
    "SELECT event_date, count(*) AS messages, count(ingest_fault) AS faulty "
    "FROM lines GROUP BY event_date"
)

SQL: dict[str, str] = {
    # bronze
    "envelope_parse": f"WITH {RAW_SQL}, {_BROKEN} "
    f"SELECT {_EVENT}, NULL AS ingest_fault, event_date FROM dated UNION ALL "
    "SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, ingest_fault, "
    "DATE '2024-02-01' FROM broken",
    "ingest_quarantine": f"WITH {RAW_SQL}, {_BROKEN} "
    "SELECT ingest_fault, count(*) AS lines FROM broken GROUP BY ingest_fault",
    "event_date_derive": _raw("SELECT event_id, event_timestamp, event_date FROM dated"),
    "bronze_ingest": _BRONZE_COUNTS,
    "bronze_backfill": _BRONZE_COUNTS,
    # silver
    "dedup_events": _raw(f"SELECT DISTINCT {_EVENT}, event_date FROM dated"),
    "dedup_conflicts": _one_of("event_id, event_date"),
    "dedup_history": _one_of("event_id"),
    "silver_types": _silver(
        "SELECT event_id, user_id, product_id, amount, event_timestamp_ts, event_date FROM typed"
    ),
    "silver_clean": _ALL_SILVER,
    "silver_enrich": _silver(
        "SELECT event_id, is_purchase_event, is_error_event, event_hour, event_day_of_week FROM silver"
    ),
    "silver_quarantine": _QUARANTINE,
    "quarantine_summary": _silver(
        "SELECT reason, count(*) AS rejected_rows FROM judged WHERE reason IS NOT NULL GROUP BY reason"
    ),
    "silver_rebuild": _ALL_SILVER,
    "undated_redelivery": _silver(
        "SELECT event_id, CASE WHEN try_cast(substr(event_timestamp, 1, 10) AS DATE) IS NULL AND n % 3 = 1 "
        "THEN DATE '2024-01-31' ELSE event_date END AS event_date, reason IS NULL AS accepted FROM judged"
    ),
    "bronze_compacted": _raw(
        "SELECT event_date, 'part-' || n % 3 AS load_id, count(*) AS messages FROM dated "
        "WHERE n % 3 <> 1 OR n % 2 = 0 GROUP BY ALL"
    ),
    "load_drift": _DRIFT,
    "silver_scan": _ALL_SILVER,
    "silver_large_dates": _ALL_SILVER,
    # gold
    "gold_daily_user_metrics": _ALL_GOLD,
    "gold_rebuild": _ALL_GOLD,
    "gold_invariants": _both_golds(
        lambda gold, label: _union(
            [
                f"SELECT '{name}' AS invariant, count(*) FILTER ({rule}) AS violations, "
                f"count(*) AS gold_rows, {label} FROM {gold}"
                for name, rule in _INVARIANTS.items()
            ]
        )
    ),
    "schema_contract": _gold(
        _union(
            [
                f"SELECT '{c}' AS column_name, '{t}' AS data_type, count({c}) AS non_null_rows, "
                "count(*) AS total_rows FROM gold"
                for c, t in _GOLD_TYPES.items()
            ]
        )
    ),
    # serving
    "serving_projection": _ALL_GOLD,
    "affected_dates": _gold("SELECT DISTINCT event_date FROM gold"),
    "publish_replace": _gold(
        "SELECT * REPLACE (events_count + CASE WHEN day(event_date) <= 15 THEN 1000 ELSE 0 END AS events_count) FROM gold"
    ),
    "dq_not_null": _both_golds(
        lambda gold, label: _union(
            [
                f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_rows, {label} FROM {gold}"
                for c in _NOT_NULL_COLUMNS
            ]
        )
    ),
    "dq_unique_key": _both_golds(
        lambda gold, label: f"SELECT count(*) AS distinct_keys, count(*) FILTER (copies > 1) AS duplicate_keys, {label} "
        f"FROM (SELECT count(*) AS copies FROM {gold} GROUP BY event_date, user_id)"
    ),
    "dq_duplicate_events": _raw(
        "SELECT event_id, event_date, count(*) AS copies FROM dated "
        "GROUP BY event_id, event_date HAVING count(*) > 1"
    ),
    "dq_reconciliation": _gold(
        _union(
            [
                "SELECT 'silver_and_quarantine_hold_every_event' AS \"check\", "
                "(SELECT count(*) FROM (SELECT DISTINCT event_id, event_date FROM dated)) AS expected, "
                "(SELECT count(*) FROM silver) + (SELECT count(*) FROM judged WHERE reason IS NOT NULL) AS actual, "
                f"'{label}' AS gold_table UNION ALL "
                "SELECT 'gold_counts_every_silver_row', (SELECT count(*) FROM silver), "
                f"{times} * (SELECT CAST(sum(events_count) AS BIGINT) FROM gold), '{label}'"
                for label, times in (("sound", 1), ("appended twice", 2))
            ]
        )
    ),
    "dq_report": _raw(
        _union(
            [
                f"SELECT '{name}' AS rule, count(*) FILTER ({rule}) AS failing, count(*) AS total FROM dated"
                for name, rule in _DQ_RULES.items()
            ]
            + [
                "SELECT 'event_id_unique', count(event_id) - count(DISTINCT event_id), count(event_id) FROM dated",
                "SELECT 'event_id_on_one_date', count(*) FILTER (dates > 1), CAST(sum(copies) AS BIGINT) "
                "FROM (SELECT event_id, count(*) AS copies, count(DISTINCT event_date) AS dates "
                "FROM dated GROUP BY event_id)",
            ]
        )
    ),
    # streaming
    "stream_equals_batch": _ALL_GOLD,
    "stream_dedup": _raw(f"SELECT DISTINCT {_EVENT}, event_date FROM dated"),
    # KPIs
    "kpi_event_revenue_daily": _silver(
        "SELECT event_date, round(sum(amount), 2) AS revenue, count(*) AS checkouts, "
        "count(DISTINCT user_id) AS buyers FROM silver WHERE event_type = 'checkout' GROUP BY event_date"
    ),
    "kpi_order_revenue_daily": """
WITH lines AS (
  SELECT l_orderkey, sum(l_extendedprice * (1 - l_discount)) AS net FROM lineitem GROUP BY l_orderkey)
SELECT CAST(o_orderdate AS DATE) AS order_date, count(*) AS orders_count,
       round(sum(o_totalprice), 2) AS gross_revenue, round(coalesce(sum(net), 0), 4) AS net_revenue
FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey GROUP BY 1
""",
    "kpi_retention": _silver(
        ", days AS (SELECT DISTINCT user_id, event_date FROM silver), "
        "firsts AS (SELECT user_id, min(event_date) AS cohort_date FROM days GROUP BY user_id), "
        "sizes AS (SELECT cohort_date, count(*) AS cohort_size FROM firsts GROUP BY cohort_date) "
        "SELECT cohort_date, CAST(event_date - cohort_date AS INTEGER) AS day_offset, "
        "count(*) AS active_users, any_value(cohort_size) AS cohort_size, "
        "count(*) / any_value(cohort_size) AS retention_rate "
        "FROM days JOIN firsts USING (user_id) JOIN sizes USING (cohort_date) GROUP BY 1, 2"
    ),
    "kpi_churn_proxy": _silver(
        ", seen AS (SELECT user_id FROM silver WHERE event_date <= DATE '2024-01-20' "
        "UNION SELECT c_custkey FROM customer), "
        "lasts AS (SELECT user_id, (SELECT max(event_date) FROM silver "
        "WHERE silver.user_id = seen.user_id AND event_date <= DATE '2024-01-20') AS last_event_date FROM seen) "
        "SELECT user_id, c_mktsegment, last_event_date, "
        "CAST(DATE '2024-01-20' - last_event_date AS INTEGER) AS days_inactive, "
        "CASE WHEN last_event_date IS NULL THEN 'never_active' "
        "WHEN last_event_date < DATE '2024-01-20' - 14 THEN 'churned' ELSE 'active' END AS activity_state "
        "FROM lasts LEFT JOIN customer ON c_custkey = user_id"
    ),
    "kpi_rfm_segments": _RFM,
    "kpi_active_users": _silver(
        "SELECT e.event_date AS as_of, CAST(days AS INTEGER) AS days, count(DISTINCT user_id) AS active_users, "
        "TRUE AS within_5_percent FROM (SELECT DISTINCT event_date FROM silver) e, (SELECT unnest([7, 28]) AS days), silver s "
        "WHERE s.event_date <= e.event_date AND s.event_date > e.event_date - days GROUP BY 1, 2"
    ),
    "kpi_quintile_cuts": "SELECT measure, share, (SELECT count(DISTINCT o_custkey) FROM orders) AS customers, TRUE AS within_bound "
    "FROM (SELECT unnest(['recency', 'frequency', 'monetary']) AS measure), "
    "(SELECT unnest([0.2::DOUBLE, 0.4::DOUBLE, 0.6::DOUBLE, 0.8::DOUBLE]) AS share)",
    "kpi_totals_by_grain": _silver(
        "SELECT event_date, event_type, page, CASE grouping_id(event_date, event_type, page) WHEN 7 THEN 'total' "
        "WHEN 3 THEN 'day' WHEN 1 THEN 'day and type' ELSE 'day and page' END AS grain, count(*) AS events_count, "
        "CAST(sum(is_purchase_event) AS BIGINT) AS checkouts, CAST(sum(is_error_event) AS BIGINT) AS errors, "
        "round(coalesce(sum(amount) FILTER (event_type = 'checkout'), 0), 2) AS revenue FROM silver "
        "GROUP BY GROUPING SETS ((), (event_date), (event_date, event_type), (event_date, page))"
    ),
    "kpi_checkout_carts": _silver(
        """
        SELECT c.event_id, c.event_date, c.user_id, c.event_timestamp_ts, c.amount, k.event_id AS cart_event_id,
          k.event_timestamp_ts AS cart_ts,
          CAST((epoch_us(c.event_timestamp_ts) - epoch_us(k.event_timestamp_ts)) // 1000000 AS BIGINT) AS seconds_since_cart
        FROM (SELECT * FROM silver WHERE event_type = 'checkout') c
        LEFT JOIN (SELECT * FROM silver WHERE event_type = 'add_to_cart') k
          ON k.user_id = c.user_id AND k.event_timestamp_ts <= c.event_timestamp_ts
            AND k.event_timestamp_ts >= c.event_timestamp_ts - INTERVAL 2 DAY
        QUALIFY row_number() OVER (PARTITION BY c.event_id, c.event_date
          ORDER BY k.event_timestamp_ts DESC NULLS LAST, k.event_id DESC) = 1
        """
    ),
    "kpi_sessions": f"WITH {RAW_SQL}, {_TYPED}, {_SESSIONS} SELECT * FROM sessions",
    "kpi_conversion_daily": f"""
        WITH {RAW_SQL}, {_TYPED}, {_SESSIONS}
        SELECT CAST(session_start AS DATE) AS event_date, count(*) AS sessions,
          count(*) FILTER (carts > 0) AS with_cart, count(*) FILTER (carts > 0 AND checkouts > 0) AS converted,
          round(sum(revenue), 2) AS revenue
        FROM sessions GROUP BY 1
    """,
    "kpi_daily_summary": _silver(
        "SELECT event_date, count(DISTINCT user_id) AS active_users, count(*) AS events_count, "
        "count(*) FILTER (event_type = 'add_to_cart') AS carts, "
        "count(*) FILTER (event_type = 'checkout') AS checkouts, "
        "count(*) FILTER (event_type = 'error') AS errors, "
        "round(coalesce(sum(amount) FILTER (event_type = 'checkout'), 0), 2) AS revenue, "
        "count(*) FILTER (event_type = 'error') / count(*) AS error_rate, "
        "count(*) FILTER (event_type = 'checkout') / "
        "nullif(count(*) FILTER (event_type = 'add_to_cart'), 0) AS cart_to_checkout "
        "FROM silver GROUP BY event_date"
    ),
    "customer_360": _gold(
        ", placed AS (SELECT o_custkey, count(*) AS orders_count, round(sum(o_totalprice), 2) AS orders_total, "
        "CAST(max(o_orderdate) AS DATE) AS last_order_date FROM orders GROUP BY o_custkey), "
        "active AS (SELECT user_id, CAST(sum(events_count) AS BIGINT) AS events_count, "
        "count(*) AS active_days, CAST(sum(page_view_count) AS BIGINT) AS page_views, "
        "CAST(sum(checkout_count) AS BIGINT) AS checkouts, CAST(sum(error_count) AS BIGINT) AS errors, "
        "round(sum(total_amount), 2) AS activity_amount, min(first_event_ts) AS first_event_ts, "
        "max(last_event_ts) AS last_event_ts FROM gold GROUP BY user_id) "
        "SELECT c_custkey, c_name, c_nationkey, c_mktsegment, c_acctbal, "
        "coalesce(orders_count, 0) AS orders_count, orders_total, last_order_date, "
        "coalesce(events_count, 0) AS events_count, coalesce(active_days, 0) AS active_days, "
        "coalesce(page_views, 0) AS page_views, coalesce(checkouts, 0) AS checkouts, "
        "coalesce(errors, 0) AS errors, activity_amount, first_event_ts, last_event_ts "
        "FROM customer LEFT JOIN placed ON c_custkey = o_custkey LEFT JOIN active ON c_custkey = user_id"
    ),
}
