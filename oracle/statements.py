"""The SQL statement of every registered query that SQL can express."""

from __future__ import annotations

from catalog import GROUP_CHARTS, NUMBER_CHARTS, TIME_CHARTS
from millrace.plans.vault import HUBS, LINKS, SATELLITES
from millrace.plans.warehouse import TABLES

from .ctes import h, statement, timeline

STATEMENTS: dict[str, str] = {name: statement(f"SELECT * FROM {name}") for name in TABLES}

_LOG_1 = "(SELECT * FROM raw_user_state_log WHERE batch = 1) AS b1"
_LOG_2 = "(SELECT * FROM raw_user_state_log WHERE batch = 2) AS b2"
_V = "value, event_id"
_CANDIDATES = """
    SELECT s.hub_key, s.hashdiff, s.load_dts, s.effective_from, CAST(NULL AS TIMESTAMP) AS effective_to, TRUE AS is_current,
           s.record_source, s.value, s.event_id
    FROM (SELECT * FROM raw_user_state_log WHERE batch = 2) AS s
    LEFT JOIN LATERAL (SELECT t.hashdiff FROM state_1 t WHERE t.hub_key = s.hub_key AND t.effective_from <= s.effective_from
                       ORDER BY t.effective_from DESC, t.load_dts DESC LIMIT 1) AS p ON TRUE
    LEFT JOIN state_1 e ON e.hub_key = s.hub_key AND e.effective_from = s.effective_from
    WHERE e.hub_key IS NULL AND (p.hashdiff IS NULL OR p.hashdiff <> s.hashdiff)"""
_MERGED = ("(SELECT hub_key, hashdiff, load_dts, effective_from, record_source, value, event_id FROM state_1 UNION ALL "
           "SELECT hub_key, hashdiff, load_dts, effective_from, record_source, value, event_id FROM state_delta) AS m")


def _newest(batch: int) -> str:
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY hub_key ORDER BY effective_from DESC, hashdiff) AS rn "
            f"FROM raw_user_state_log WHERE batch = {batch}) AS r WHERE rn = 1")


VERSIONS = {
    "state_1": timeline(_LOG_1, _V),
    "state_delta": _CANDIDATES,
    "state_2": timeline(_MERGED, _V),
    "newest_1": _newest(1), "newest_2": _newest(2),
    "rates": """
        SELECT d AS rate_date, c AS currency, day(d) / 2.0::DOUBLE + CASE WHEN c = 'USD' THEN 60 ELSE 70 END AS rate_to_rub
        FROM (SELECT order_date AS d FROM fct_daily_sales UNION SELECT order_date FROM fct_orders WHERE order_date IS NOT NULL) AS x,
             (SELECT unnest(['USD', 'EUR']) AS c) AS y""",
    "mart_daily_finance_rub": """
        SELECT '20010802_000000' AS run_id, s.order_date, s.currency, CAST(s.gross_sales AS DOUBLE) AS gross_sales,
               coalesce(r.rate_to_rub, 1.0) AS rate_to_rub,
               round(CAST(s.gross_sales AS DOUBLE) * coalesce(r.rate_to_rub, 1.0), 4) AS gross_sales_rub, s.order_count, s.avg_order_value
        FROM fct_daily_sales s LEFT JOIN rates r ON r.rate_date = s.order_date AND r.currency = s.currency
        WHERE s.order_date IS NOT NULL""",
    "mart_order_mix_rub": """
        SELECT '20010802_000000' AS run_id, o.order_date, o.currency, o.payment_state, count(*) AS order_count,
               CAST(sum(o.total_amount) AS DOUBLE) AS revenue_orig,
               round(CAST(sum(o.total_amount) AS DOUBLE) * coalesce(any_value(r.rate_to_rub), 1.0), 4) AS revenue_rub
        FROM fct_orders o LEFT JOIN rates r ON r.rate_date = o.order_date AND r.currency = o.currency
        WHERE o.order_date IS NOT NULL GROUP BY ALL""",
}


def add(name: str, select: str) -> None:
    STATEMENTS[name] = statement(select, VERSIONS)


add("sat_first_load", "SELECT * FROM state_1")
add("sat_late_delta", "SELECT * FROM state_delta")
add("sat_merge_detector", "SELECT * FROM state_delta")
add("sat_after_late_load", "SELECT * FROM state_2")
add("sat_end_dated", """
    SELECT hub_key, hashdiff, load_dts, effective_from, lead(effective_from) OVER w AS effective_to,
           lead(effective_from) OVER w IS NULL AS is_current, record_source, value, event_id
    FROM raw_user_state_log WINDOW w AS (PARTITION BY hub_key ORDER BY effective_from, hashdiff)""")
add("sat_lossless", timeline("raw_user_state_log", _V))
add("stream_satellite", timeline("raw_user_state_log", _V))
add("sat_order_history", timeline("order_snapshots", "status, currency, total_amount, order_ts"))
add("sat_close_and_insert", """
    SELECT hub_key, hashdiff, load_dts, effective_from, lead(effective_from) OVER w AS effective_to,
           lead(effective_from) OVER w IS NULL AS is_current, record_source, value, event_id
    FROM (SELECT * FROM newest_1 UNION ALL
          SELECT n.* FROM newest_2 n LEFT JOIN newest_1 o ON o.hub_key = n.hub_key
          WHERE o.hub_key IS NULL OR o.hashdiff <> n.hashdiff) AS u
    WINDOW w AS (PARTITION BY hub_key ORDER BY effective_from)""")
add("plain_hub_orders", "SELECT DISTINCT sha256(CAST(order_id AS VARCHAR)) AS order_hk, CAST(order_id AS VARCHAR) AS order_bk FROM clean_orders")
add("plain_link_customer_orders", """
    SELECT DISTINCT sha256(customer_id || '||' || order_id) AS link_hk, sha256(CAST(customer_id AS VARCHAR)) AS customer_hk,
           sha256(CAST(order_id AS VARCHAR)) AS order_hk FROM clean_orders""")
add("plain_sat_order_status", """
    SELECT sha256(CAST(order_id AS VARCHAR)) AS order_hk, order_ts AS effective_from,
           sha256(status || '||' || total_amount || '||' || currency_code) AS hash_diff, status, total_amount,
           currency_code AS currency FROM clean_orders""")
add("vault_row_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in (
        "hub_customers", "hub_orders", "link_customer_order", "sat_customer_details", "sat_order_status")))
add("hub_increment", "SELECT * FROM hub_orders WHERE load_dts >= TIMESTAMP '2000-01-01'")
add("link_increment", "SELECT * FROM link_customer_order WHERE load_dts >= TIMESTAMP '2000-01-01'")


def _pointers(sat: str, alias: str, eod: str) -> str:
    return (f"LEFT JOIN LATERAL (SELECT s.load_dts AS {alias}_load_dts, s.hashdiff AS {alias}_hashdiff, "
            f"s.effective_from AS {alias}_effective_from FROM {sat} s WHERE s.hub_key = d.hub_key AND s.effective_from <= {eod} "
            f"AND (s.effective_to IS NULL OR s.effective_to > {eod}) ORDER BY s.effective_from DESC LIMIT 1) AS {alias}_p ON TRUE ")


_EOD = "CAST(d.as_of_date AS TIMESTAMP) + INTERVAL 1 DAY - INTERVAL 1 SECOND"
_SPINE = ("(SELECT hub_key, CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY)) AS DATE) AS as_of_date "
          "FROM (SELECT DISTINCT hub_key FROM state_2) AS h) AS d ")
add("pit_user_state", "SELECT d.hub_key, d.as_of_date, state_load_dts, state_hashdiff, state_effective_from, first_load_dts, "
    f"first_hashdiff, first_effective_from FROM {_SPINE}{_pointers('state_2', 'state', _EOD)}{_pointers('state_1', 'first', _EOD)}")
add("pit_increment", "SELECT d.hub_key, d.as_of_date, state_load_dts, state_hashdiff, state_effective_from "
    f"FROM {_SPINE}{_pointers('state_2', 'state', _EOD)}")
add("bridge_generic", f"""
    SELECT {h('l.link_key', 'l.order_hub_key', 'l.payment_hub_key')} AS bridge_key, l.link_key, l.order_hub_key, l.payment_hub_key,
           l.load_dts, l.record_source
    FROM link_order_payment l JOIN hub_orders o ON o.hub_key = l.order_hub_key JOIN hub_payments p ON p.hub_key = l.payment_hub_key""")

add("upsert_orders", """
    SELECT o.order_id, o.customer_id, o.order_ts, CASE WHEN n.order_id IS NOT NULL THEN 'audited' ELSE o.status END AS status,
           o.currency_code, o.total_amount, o.source_record_hash
    FROM (SELECT * FROM clean_orders WHERE order_ts < TIMESTAMP '2000-01-01') AS o
    LEFT JOIN (SELECT order_id FROM clean_orders WHERE total_amount >= 100000) AS n ON n.order_id = o.order_id
    UNION ALL
    SELECT order_id, NULL, NULL, 'audited', NULL, NULL, NULL FROM clean_orders WHERE order_ts >= TIMESTAMP '2000-01-01'""")
add("insert_absent_orders", """
    SELECT order_id, CASE WHEN order_ts < TIMESTAMP '2000-01-01' THEN status ELSE 'new' END AS status FROM clean_orders""")
add("replace_daily_sales", """
    SELECT * REPLACE (CASE WHEN order_date >= (SELECT max(order_date) - 7 FROM fct_daily_sales WHERE order_date <= DATE '2000-01-01')
                      THEN order_count ELSE 0 END AS order_count) FROM fct_daily_sales""")
add("evolved_union", """
    SELECT hub_key, business_key, load_dts, record_source, NULL AS link_key FROM hub_orders
    UNION ALL SELECT NULL, NULL, load_dts, record_source, link_key FROM link_customer_order""")
add("kpi_snapshot", """
    SELECT 'daily_sales_gross' AS metric_key, CAST(coalesce(sum(gross_sales), 0) AS DECIMAL(18,4)) AS metric_value_num,
           CAST(NULL AS VARCHAR) AS metric_value_text FROM fct_daily_sales WHERE order_date = DATE '2001-08-02'
    UNION ALL SELECT 'active_customers_30d', CAST(count(DISTINCT customer_hub_key) AS DECIMAL(18,4)), NULL FROM fct_orders
              WHERE order_date >= DATE '2001-08-02' - 30
    UNION ALL SELECT * FROM (SELECT 'top_currency', CAST(NULL AS DECIMAL(18,4)), currency FROM fct_orders GROUP BY currency
              ORDER BY count(*) DESC, currency LIMIT 1) AS t""")
add("rate_dates", "SELECT DISTINCT order_date FROM fct_orders WHERE order_date IS NOT NULL")
add("mart_daily_finance_rub", "SELECT * FROM mart_daily_finance_rub")
add("mart_order_mix_rub", "SELECT * FROM mart_order_mix_rub")

_T = "DATE '2001-08-02'"
add("panel_gmv_today", f"SELECT CAST(coalesce(sum(gmv), 0) AS DOUBLE) AS value FROM mart_daily_business_kpis WHERE metric_date = {_T}")
add("panel_net_revenue_30d", f"SELECT CAST(coalesce(sum(net_revenue), 0) AS DOUBLE) AS value FROM mart_daily_business_kpis WHERE metric_date >= {_T} - 30")
add("panel_aov_30d", f"SELECT CASE WHEN sum(orders_count) = 0 THEN 0 ELSE CAST(sum(gmv) AS DOUBLE) / CAST(sum(orders_count) AS DOUBLE) END AS value "
    f"FROM mart_daily_business_kpis WHERE metric_date >= {_T} - 30")
add("panel_d30_retention", f"SELECT coalesce(round(avg(retention_rate), 6), 0) AS value FROM mart_cohort_retention "
    f"WHERE canonical_day_marker = 30 AND activity_date >= {_T} - 90")
add("panel_gmv_trend_60d", f"SELECT metric_date AS time, CAST(sum(gmv) AS DOUBLE) AS gmv, CAST(sum(net_revenue) AS DOUBLE) AS net_revenue "
    f"FROM mart_daily_business_kpis WHERE metric_date >= {_T} - 60 GROUP BY 1")
add("panel_new_repeat_60d", f"SELECT metric_date AS time, CAST(sum(new_buyers_count) AS DOUBLE) AS new_buyers, "
    f"CAST(sum(repeat_buyers_count) AS DOUBLE) AS repeat_buyers FROM mart_daily_business_kpis WHERE metric_date >= {_T} - 60 GROUP BY 1")
add("panel_top_categories", f"SELECT category, CAST(sum(gross_revenue) AS DOUBLE) AS value FROM mart_category_performance "
    f"WHERE metric_date >= {_T} - 30 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
add("panel_channel_budget_90d", f"SELECT metric_date AS time, channel, CAST(sum(planned_budget) AS DOUBLE) AS value "
    f"FROM mart_marketing_channel WHERE metric_date >= {_T} - 90 GROUP BY 1, 2")
add("panel_unit_economics", "SELECT cohort_month, customers_count, avg_ltv_30d, avg_ltv_90d, avg_ltv_180d, avg_ltv_365d, avg_cac, "
    "ltv_cac_ratio, payback_months, limitations_note FROM mart_unit_economics ORDER BY cohort_month DESC LIMIT 24")


def _measure(kind: str, column: str | None) -> str:
    return {"count": "CAST(count(*) AS DOUBLE)", "sum": f"round(CAST(sum({column}) AS DOUBLE), 3)",
            "avg": f"CAST(sum({column}) AS DOUBLE) / count({column})", "max": f"CAST(max({column}) AS DOUBLE)"}[kind]


for _name, (_table, _kind, _column) in NUMBER_CHARTS.items():
    add(_name, f"SELECT coalesce({_measure(_kind, _column)}, 0.0) AS value FROM {_table}")
for _name, (_table, _by, _kind, _column, _rows) in GROUP_CHARTS.items():
    add(_name, f"SELECT {_by}, {_measure(_kind, _column)} AS value FROM {_table} GROUP BY 1 ORDER BY 2 DESC NULLS LAST, 1 NULLS LAST LIMIT {_rows}")
for _name, (_table, _day, _values) in TIME_CHARTS.items():
    _sums = ", ".join(f"CAST(sum({c}) AS DOUBLE) AS {n}" for n, c in _values.items())
    add(_name, f"SELECT {_day} AS time, {_sums} FROM {_table} GROUP BY 1")
add("chart_orders_by_day", "SELECT order_date AS time, count(*) AS orders FROM fct_orders GROUP BY 1")
add("chart_retention_by_day", "SELECT activity_date AS time, round(avg(retention_rate), 9) AS retention_rate FROM mart_cohort_retention GROUP BY 1")
add("kpi_top_products", """
    SELECT b.product_hub_key, CAST(sum(b.total_line_amount) AS DECIMAL(24,2)) AS revenue, p.product_bk, p.product_name
    FROM bridge_order_product b JOIN dim_products p ON p.product_hub_key = b.product_hub_key GROUP BY ALL ORDER BY 2 DESC, 3 LIMIT 20""")
add("kpi_items_per_order", "SELECT CAST(sum(total_quantity) AS DOUBLE) / count(total_quantity) AS avg_items_per_order FROM fct_orders")
add("kpi_rolling_retention", "SELECT CAST(date_trunc('month', first_order_date) AS DATE) AS cohort_month, count(*) AS cohort_size, " + ", ".join(
    f"CAST(count(*) FILTER (WHERE last_order_date - first_order_date >= {n}) AS DOUBLE) / count(*) AS rolling_{n}d" for n in (1, 7, 30, 90))
    + " FROM mart_user_rfm GROUP BY 1")
add("kpi_purchase_frequency", "SELECT CAST(sum(orders_total) AS DOUBLE) / count(*) AS orders_per_customer, "
    "CAST(count(*) FILTER (WHERE orders_total > 1) AS DOUBLE) / count(*) AS repeat_share FROM mart_user_rfm")


def _frame(days: int) -> str:
    return f"(PARTITION BY currency ORDER BY order_date RANGE BETWEEN INTERVAL {days} DAY PRECEDING AND CURRENT ROW)"


add("agg_daily_sales_calendar", f"""
    SELECT *, CASE WHEN gross_sales_lag_7d <> 0 THEN CAST(gross_sales - gross_sales_lag_7d AS DOUBLE) / CAST(gross_sales_lag_7d AS DOUBLE) END AS wow_growth
    FROM (SELECT s.*, CAST(sum(s.gross_sales) OVER {_frame(6)} AS DOUBLE) / count(*) OVER {_frame(6)} AS gross_sales_7d_ma,
                 CAST(sum(s.gross_sales) OVER {_frame(29)} AS DOUBLE) / count(*) OVER {_frame(29)} AS gross_sales_30d_ma,
                 b.before AS gross_sales_lag_7d
          FROM fct_daily_sales s LEFT JOIN (SELECT order_date + 7 AS day, currency AS cur, gross_sales AS before FROM fct_daily_sales) AS b
            ON b.day = s.order_date AND b.cur = s.currency) AS w""")

_ORDER_COLUMNS = "order_id, user_id, order_ts, status, currency_code, total_amount"
add("extract_after_timestamp", f"SELECT {_ORDER_COLUMNS} FROM raw_oltp_orders WHERE order_ts > TIMESTAMP '1998-06-01' "
    "ORDER BY order_ts, order_id, ingested_at LIMIT 5000")
add("extract_after_keyset", f"SELECT {_ORDER_COLUMNS} FROM raw_oltp_orders WHERE order_ts > TIMESTAMP '1998-06-01' "
    "OR (order_ts = TIMESTAMP '1998-06-01' AND order_id > 700) ORDER BY order_ts, order_id, ingested_at LIMIT 5000")
add("extract_full", "SELECT order_item_id, order_id, product_id, quantity, unit_price FROM raw_oltp_order_items")


def _j(name: str) -> str:
    return f"nullif(CASE WHEN json_valid(value) THEN json_extract_string(value, '$.{name}') END, '')"


_WHEN = f"coalesce({_j('event_timestamp')}, {_j('event_ts')}, {_j('timestamp')}, {_j('ts')})"
_MOMENT = (f"CASE WHEN TRY_CAST({_WHEN} AS DOUBLE) > 1e12 THEN make_timestamp(CAST({_WHEN} AS BIGINT) * 1000) "
           f"WHEN TRY_CAST({_WHEN} AS DOUBLE) IS NOT NULL THEN make_timestamp(CAST({_WHEN} AS BIGINT) * 1000000) "
           f"ELSE TRY_CAST(replace({_WHEN}, 'Z', '') AS TIMESTAMP) END")
_PAYLOAD = "CASE WHEN json_valid(value) THEN value ELSE '{\"_raw\":\"' || value || '\"}' END AS payload"
_POSITION = 'topic, partition AS partition_id, "offset" AS kafka_offset'
VERSIONS["parsed_orders"] = f"""
    SELECT {_POSITION}, {_j('event_id')} AS event_id, {_j('event_type')} AS event_type, CAST({_j('order_id')} AS BIGINT) AS order_id,
           CAST(coalesce({_j('customer_id')}, {_j('user_id')}) AS BIGINT) AS customer_id,
           CAST(coalesce({_j('total_amount')}, {_j('amount')}) AS DECIMAL(14,2)) AS total_amount, left({_j('currency')}, 3) AS currency,
           left({_j('country_code')}, 2) AS country_code, {_PAYLOAD}, {_MOMENT} AS event_ts FROM raw_order_messages"""
VERSIONS["parsed_payments"] = f"""
    SELECT {_POSITION}, {_j('event_id')} AS event_id, {_j('event_type')} AS event_type, CAST({_j('payment_id')} AS BIGINT) AS payment_id,
           CAST({_j('order_id')} AS BIGINT) AS order_id, {_j('transaction_id')} AS transaction_id,
           CAST({_j('amount')} AS DECIMAL(14,2)) AS amount, {_j('currency')} AS currency, {_j('payment_method')} AS payment_method,
           {_j('status')} AS status, {_j('decline_reason')} AS decline_reason, {_PAYLOAD}, {_MOMENT} AS event_ts FROM raw_payment_messages"""
add("parsed_orders", "SELECT * FROM parsed_orders")
add("parsed_payments", "SELECT * FROM parsed_payments")
add("parsed_extension_events", f"""
    SELECT {_POSITION}, 'orders' AS domain_code, CASE WHEN json_valid(value) THEN json_extract_string(value, '$.event_id') END AS event_id,
           {_j('event_type')} AS event_type, {_PAYLOAD}, coalesce({_MOMENT}, timestamp) AS event_ts FROM raw_order_messages""")
add("parsed_file_payments", f"""
    SELECT 'payments/batch.jsonl::' || {_j('payment_id')} AS event_uuid, 'payments/batch.jsonl' AS source_file,
           CAST({_j('payment_id')} AS BIGINT) AS payment_id, CAST({_j('order_id')} AS BIGINT) AS order_id,
           CAST({_j('amount')} AS DECIMAL(14,2)) AS amount, {_j('currency')} AS currency, {_j('status')} AS status, {_MOMENT} AS event_ts
    FROM raw_payment_messages""")
add("message_projection", 'SELECT topic, partition, "offset", timestamp, value AS value_json FROM raw_change_messages')
add("contract_orders", """
    SELECT kafka_offset, concat_ws(',', CASE WHEN event_id IS NULL THEN 'required:event_id' END,
             CASE WHEN order_id IS NULL THEN 'required:order_id' END, CASE WHEN event_ts IS NULL THEN 'required:event_ts' END,
             CASE WHEN total_amount < 0 THEN 'non_negative:total_amount' END,
             CASE WHEN NOT regexp_full_match(country_code, '[A-Z]{2}') THEN 'iso_country:country_code' END,
             CASE WHEN NOT regexp_full_match(currency, '[A-Z]{3}') THEN 'iso_currency:currency' END,
             CASE WHEN event_type NOT IN ('order.created', 'order.updated', 'order.cancelled') THEN 'allowed:event_type' END) AS violations
    FROM parsed_orders""")
add("contract_payments", """
    SELECT kafka_offset, 'allowed:status' AS violations FROM parsed_payments
    WHERE status NOT IN ('authorized', 'captured', 'declined', 'refunded')""")
add("contract_clean_orders", "SELECT * FROM clean_orders WHERE total_amount > 0")
add("ingest_slice", "SELECT * FROM raw_oltp_orders WHERE ingested_at BETWEEN TIMESTAMP '1999-01-01' AND TIMESTAMP '2000-01-01'")
add("landing_payments", "SELECT event_id, payment_id, order_id, amount, currency, status, event_ts FROM parsed_payments WHERE status <> 'DECLINED'")
add("landing_catalog", "SELECT CAST(product_id AS VARCHAR) AS product_id, CAST(seller_id AS VARCHAR) AS seller_id, product_name, category, "
    "CAST(price AS VARCHAR) AS price, CAST(is_active AS VARCHAR) AS is_active FROM raw_oltp_products")
_STATE = """
    SELECT user_id, state, CAST(value AS DECIMAL(12,2)) AS value
    FROM (SELECT user_id, event_type AS state, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn
          FROM events) AS r WHERE rn = 1 AND state <> 'error'"""
add("changes_applied", _STATE)
add("landing_manifest", """
    SELECT 'payments' AS prefix, 'loaded' AS status, count(*) FILTER (NOT contains("value", 'DECLINED')) AS rows_loaded, CAST(NULL AS VARCHAR) AS error
    FROM raw_payment_messages
    UNION ALL SELECT 'products', 'loaded', count(*), NULL FROM raw_oltp_products
    UNION ALL SELECT 'products', 'quarantined', 0, 'unsupported file format'
    UNION ALL SELECT 'orders', 'loaded', count(*), NULL FROM raw_oltp_orders""")
add("landing_quarantine", """SELECT 'broken ' || "value" AS line FROM raw_payment_messages WHERE contains("value", 'DECLINED')""")
add("stream_changes_applied", _STATE)
add("ingested_messages", """
    SELECT topic, "partition" AS partition_id, count(*) AS n, max("offset") AS last_offset FROM raw_order_messages GROUP BY 1, 2""")
add("stream_event_log", "SELECT DISTINCT topic, partition_id, kafka_offset, event_type, payload FROM raw_kafka_extension_events")


def _check(name: str, table: str, severity: str, count: str, expected: str = "0", passed: str = "n = 0") -> str:
    return (f"SELECT '{name}' AS check_name, '{table}' AS table_name, '{severity}' AS severity, {passed} AS passed, "
            f"CAST(n AS VARCHAR) AS observed_value, '{expected}' AS expected_value FROM (SELECT {count}) AS c")


def _dup(table: str, columns: str) -> str:
    return f"count(*) AS n FROM (SELECT {columns} FROM {table} GROUP BY ALL HAVING count(*) > 1) AS d"


def _orphan(child: str, column: str, parent: str, parent_column: str, extra: str = "TRUE") -> str:
    return (f"count(*) AS n FROM {child} c LEFT JOIN (SELECT DISTINCT {parent_column} AS k FROM {parent}) AS p ON c.{column} = p.k "
            f"WHERE p.k IS NULL AND {extra}")


_FILE_IDS = "(SELECT 'pay-' || payment_id AS event_id FROM raw_file_payments)"
_TWO = "(SELECT * FROM state_2 UNION ALL SELECT * FROM state_1)"
_DQ_RESULTS = " UNION ALL ".join([
    _check("stg_customers_pk_unique", "clean_customers", "critical", _dup("clean_customers", "customer_id")),
    _check("stg_orders_not_null", "clean_orders", "critical",
           "count(*) AS n FROM clean_orders WHERE order_id IS NULL OR customer_id IS NULL OR order_ts IS NULL OR status IS NULL"),
    _check("stg_orders_total_positive", "clean_orders", "error", "count(*) AS n FROM clean_orders WHERE total_amount < 0"),
    _check("vault_hub_customers_unique_bk", "hub_customers", "critical", _dup("hub_customers", "business_key")),
    _check("vault_link_referential_integrity", "link_customer_order", "critical",
           _orphan("link_customer_order", "customer_hub_key", "hub_customers", "hub_key")),
    _check("vault_sat_customer_one_current", "sat_customer_details", "critical",
           "count(*) AS n FROM (SELECT hub_key FROM sat_customer_details WHERE is_current GROUP BY 1 HAVING count(*) > 1) AS d"),
    _check("vault_sat_order_one_current", "sat_order_status", "critical",
           "count(*) AS n FROM (SELECT hub_key FROM sat_order_status GROUP BY 1 HAVING count(*) FILTER (WHERE is_current) <> 1) AS d"),
    _check("marts_fct_orders_referential", "fct_orders", "error",
           _orphan("fct_orders", "customer_hub_key", "dim_customers", "customer_hub_key")),
    _check("marts_fct_orders_amount_positive", "fct_orders", "error", "count(*) AS n FROM fct_orders WHERE total_amount < 0"),
    _check("raw_items_unique", "raw_items", "warning", _dup("raw_oltp_order_items", "order_item_id")),
    _check("raw_payments_event_id", "raw_payments", "warning", "count(*) AS n FROM raw_kafka_payments WHERE event_id IS NULL"),
    _check("raw_payments_amount_range", "raw_payments", "warning",
           "count(*) AS n FROM raw_kafka_payments WHERE amount < 5000 OR amount > 400000"),
    _check("raw_payments_amount_unbounded", "raw_payments", "warning", "0 AS n"),
    _check("payment_orders_known", "raw_payments", "warning", _orphan("raw_kafka_payments", "event_id", _FILE_IDS, "event_id")),
    _check("payment_orders_known_if_set", "raw_payments", "warning",
           _orphan("raw_kafka_payments", "event_id", _FILE_IDS, "event_id", "c.event_id IS NOT NULL")),
    _check("customer_segment_accepted", "dim_customers", "error",
           "count(*) AS n FROM dim_customers WHERE customer_segment NOT IN ('platinum', 'gold', 'silver', 'bronze')"),
    _check("payment_state_accepted", "fct_orders", "error",
           "count(*) AS n FROM fct_orders WHERE payment_state NOT IN ('fully_paid', 'partially_paid')"),
    _check("price_not_negative", "dim_products", "error", "count(*) AS n FROM dim_products WHERE price < 0"),
    _check("amount_predicate", "fct_orders", "warning", "count(*) AS n FROM fct_orders WHERE total_amount > 300000"),
    _check("orders_present", "fct_orders", "error", "count(*) AS n FROM fct_orders", ">=1000000000", "n >= 1000000000"),
    _check("retention_grain_unique", "mart_cohort_retention", "error",
           _dup("mart_cohort_retention", "cohort_month, activity_date, days_since_first_order")),
    _check("retention_two_column_grain", "mart_cohort_retention", "warning",
           _dup("mart_cohort_retention", "cohort_month, activity_date")),
])
add("dq_results", _DQ_RESULTS)
add("dq_result_log", f"SELECT *, CAST(NULL AS VARCHAR) AS error FROM ({_DQ_RESULTS}) AS r")
add("dq_failing_duplicates", "SELECT order_item_id, count(*) AS row_count FROM raw_oltp_order_items GROUP BY 1 HAVING count(*) > 1")
add("dq_failing_orphans", f"""
    SELECT c.topic, c.partition_id, c.kafka_offset, c.event_id FROM raw_kafka_payments c
    LEFT JOIN {_FILE_IDS} AS p ON p.event_id = c.event_id WHERE p.event_id IS NULL""")
add("dq_sat_gaps", f"""
    SELECT hub_key, effective_from, effective_to, next_from
    FROM (SELECT *, lead(effective_from) OVER (PARTITION BY hub_key ORDER BY effective_from, effective_to NULLS FIRST) AS next_from
          FROM {_TWO} AS u) AS o
    WHERE next_from IS NOT NULL AND effective_to IS DISTINCT FROM next_from""")
add("dq_sat_overlaps", f"""
    SELECT DISTINCT b.hub_key, b.effective_from FROM {_TWO} AS a JOIN {_TWO} AS b
      ON a.hub_key = b.hub_key AND (a.effective_from < b.effective_from
         OR (a.effective_from = b.effective_from AND (a.effective_to IS DISTINCT FROM b.effective_to)))
    WHERE coalesce(a.effective_to, TIMESTAMP '9999-12-31') > b.effective_from
    UNION SELECT hub_key, effective_from FROM {_TWO} AS c GROUP BY 1, 2 HAVING count(*) > 1""")
add("dq_sat_one_current", f"SELECT hub_key, count(*) FILTER (WHERE is_current) AS current_rows FROM {_TWO} AS u GROUP BY 1 "
    "HAVING count(*) FILTER (WHERE is_current) <> 1")
add("dq_pit_violations", f"""
    SELECT p.hub_key, p.as_of_date, p.s_load_dts AS load_dts, p.s_effective_from AS effective_from, v.effective_to
    FROM (SELECT d.hub_key, d.as_of_date, s_load_dts, s_effective_from FROM {_SPINE}{_pointers('state_1', 's', _EOD)}) AS p
    LEFT JOIN state_2 v ON v.hub_key = p.hub_key AND v.load_dts = p.s_load_dts AND v.effective_from = p.s_effective_from
    WHERE p.s_load_dts IS NOT NULL AND (v.hub_key IS NULL
       OR v.effective_from > CAST(p.as_of_date AS TIMESTAMP) + INTERVAL 1 DAY - INTERVAL 1 SECOND
       OR v.effective_to <= CAST(p.as_of_date AS TIMESTAMP) + INTERVAL 1 DAY - INTERVAL 1 SECOND)""")
add("dq_bridge_violations", """
    SELECT b.* FROM bridge_customer_order b LEFT JOIN link_customer_order AS l
      ON l.link_key = b.link_key AND l.customer_hub_key = b.customer_hub_key AND l.order_hub_key = b.order_hub_key AND l.load_dts < TIMESTAMP '2001-06-01'
    WHERE l.link_key IS NULL""")
add("dq_business_rules", """
    SELECT 'segments' AS table_name, count(*) AS row_count FROM dim_customers WHERE customer_segment NOT IN ('platinum', 'gold', 'silver', 'bronze')
    UNION ALL SELECT 'prices', count(*) FROM dim_products WHERE price < 0
    UNION ALL SELECT 'payment_states', count(*) FROM fct_orders
      WHERE has_successful_payment AND coalesce(payment_state, 'unpaid') NOT IN ('fully_paid', 'partially_paid')
    UNION ALL SELECT 'success_rates', count(*) FROM agg_payment_performance WHERE success_rate < 0 OR success_rate > 1""")


def _fresh(name: str, table: str, column: str, warn: int, error: int) -> str:
    return (f"SELECT '{name}' AS table_name, newest, age AS age_minutes, CASE WHEN newest IS NULL OR age > {error} THEN 'error' "
            f"WHEN age > {warn} THEN 'warn' ELSE 'pass' END AS status FROM (SELECT max({column}) AS newest, "
            f"CAST(trunc(epoch({'TIMESTAMP' + chr(39)}2001-08-02{chr(39)} - max({column})) / 60) AS BIGINT) AS age FROM {table}) AS f")


add("dq_freshness", " UNION ALL ".join([
    _fresh("oltp_orders", "raw_oltp_orders", "ingested_at", 30, 120), _fresh("kafka_payments", "raw_kafka_payments", "ingested_at", 15, 60),
    _fresh("file_payments", "raw_file_payments", "loaded_at", 60, 240),
    _fresh("extension_events", "raw_kafka_extension_events", "ingested_at", 60, 180)]))
add("dq_layer_counts", """
    SELECT 'customers' AS table_name, (SELECT count(*) FROM raw_oltp_users) AS raw_rows, (SELECT count(*) FROM stg_customers) AS staged_rows, 'pass' AS verdict
    UNION ALL SELECT 'orders', (SELECT count(*) FROM raw_oltp_orders), (SELECT count(*) FROM stg_orders), 'pass'
    UNION ALL SELECT 'emptied', (SELECT count(*) FROM raw_oltp_orders), 0, 'fail'""")
add("dq_layer_offenders", "SELECT count(*) AS failing, 'emptied' AS tables FROM (SELECT count(*) AS n FROM raw_oltp_orders) AS r WHERE n > 0")

_LAST = "SELECT topic, partition_id, max(kafka_offset) AS last_offset FROM raw_kafka_extension_events"
add("offsets_last", f"{_LAST} GROUP BY 1, 2")
add("offsets_merged", """
    SELECT 'payments' AS topic, '{' || string_agg('"' || partition_id || '":' || o, ',' ORDER BY partition_id) || '}' AS watermark_value
    FROM (SELECT coalesce(n.partition_id, p.partition_id) AS partition_id, coalesce(n.o, p.o) AS o
          FROM (SELECT partition_id, max(kafka_offset) - 10 AS o FROM raw_kafka_payments GROUP BY 1) AS p
          FULL JOIN (SELECT partition_id, max(kafka_offset) AS o FROM raw_kafka_orders GROUP BY 1) AS n
            ON n.partition_id = p.partition_id) AS m""")
add("offsets_lag", f"""
    SELECT h.topic, h.partition_id, h.last_offset + 1 AS high_offset, s.last_offset,
           greatest(0, h.last_offset + 1 - greatest(coalesce(s.last_offset, -1) + 1, 0)) AS lag
    FROM ({_LAST} GROUP BY 1, 2) AS h
    LEFT JOIN (SELECT topic, partition_id, max(kafka_offset) - 5 * partition_id AS last_offset FROM raw_kafka_extension_events GROUP BY 1, 2) AS s
      ON s.topic = h.topic AND s.partition_id = h.partition_id""")
add("ingestion_lag", """
    SELECT topic, max(ingested_at) AS newest,
           greatest(CAST(trunc(epoch(TIMESTAMP '2024-01-31' - max(ingested_at))) AS BIGINT), 0) AS lag_seconds
    FROM raw_kafka_extension_events GROUP BY 1""")
_RECENT = "SELECT * FROM raw_pipeline_runs WHERE started_at >= TIMESTAMP '2024-01-31' - INTERVAL 7 DAY"
VERSIONS["recent"] = _RECENT
VERSIONS["recent_view"] = """
    SELECT run_id, dag_id, task_id, source, layer, status, started_at, finished_at,
           CAST(trunc(epoch(coalesce(finished_at, TIMESTAMP '2024-01-31') - started_at)) AS BIGINT) AS duration_seconds, rows_in, rows_out,
           rows_quarantined, error_message FROM recent"""
VERSIONS["run_sums"] = """
    SELECT dag_id, layer, count(*) FILTER (WHERE status = 'success') AS runs_success, count(*) FILTER (WHERE status = 'failed') AS runs_failed,
           CAST(coalesce(sum(rows_in), 0) AS BIGINT) AS total_rows_in, CAST(coalesce(sum(rows_out), 0) AS BIGINT) AS total_rows_out,
           max(finished_at) AS last_finished_at FROM recent GROUP BY 1, 2"""
add("runs_recent", "SELECT * FROM recent_view")
add("runs_summary", "SELECT * FROM run_sums")
add("runs_success_ratio", "SELECT coalesce(CAST(sum(runs_success) AS DOUBLE) / nullif(sum(runs_success + runs_failed), 0), 0) AS ratio FROM run_sums")
add("runs_over_time", "SELECT started_at AS time, status AS metric, CAST(count(*) AS DOUBLE) AS value FROM raw_pipeline_runs "
    "WHERE started_at >= TIMESTAMP '2024-01-30' GROUP BY 1, 2")
add("runs_state_counts", "SELECT status, count(*) AS n FROM recent GROUP BY 1")
add("runs_longest", "SELECT dag_id, run_id, status, started_at, finished_at, CAST(trunc(epoch(finished_at - started_at)) AS BIGINT) AS duration_sec "
    "FROM recent WHERE finished_at IS NOT NULL ORDER BY 6 DESC, started_at DESC, run_id LIMIT 20")
add("runs_latest_failures", "SELECT dag_id, run_id, started_at, finished_at FROM recent WHERE status = 'failed' ORDER BY started_at DESC, run_id LIMIT 30")
add("runs_latest", "SELECT * FROM recent_view ORDER BY started_at DESC, run_id LIMIT 50")
add("runs_started", """
    SELECT * REPLACE (CASE WHEN status = 'running' THEN TIMESTAMP '2024-01-31' ELSE started_at END AS started_at,
                      CASE WHEN status <> 'running' THEN finished_at END AS finished_at, CASE WHEN status <> 'running' THEN rows_in END AS rows_in,
                      CASE WHEN status <> 'running' THEN rows_out END AS rows_out, CASE WHEN status <> 'running' THEN rows_quarantined END AS rows_quarantined,
                      CASE WHEN status <> 'running' THEN error_message END AS error_message) FROM raw_pipeline_runs""")
add("runs_finished", """
    SELECT * REPLACE (CASE WHEN status = 'running' THEN started_at ELSE finished_at END AS finished_at,
                      CASE WHEN status = 'running' THEN 5 ELSE rows_in END AS rows_in, CASE WHEN status = 'running' THEN 5 ELSE rows_out END AS rows_out,
                      CASE WHEN status = 'running' THEN 0 ELSE rows_quarantined END AS rows_quarantined,
                      CASE WHEN status = 'running' THEN '{"k":' || (payload->>'k') || ',"done":true}' ELSE payload END AS payload,
                      CASE WHEN status = 'running' THEN 'success' ELSE status END AS status) FROM raw_pipeline_runs""")

_R = {"ctr": ("clicks", "impressions", 4), "cpc": ("spend", "clicks", 2), "cpa": ("spend", "conversions", 2), "roas": ("revenue", "spend", 2)}
add("campaign_ratios", "SELECT *, " + ", ".join(
    f"CASE WHEN {d} <> 0 THEN (2 * CAST({n} * 100 AS HUGEINT) * {10 ** k} + CAST({d} * 100 AS HUGEINT)) // (2 * CAST({d} * 100 AS HUGEINT)) "
    f"/ {10 ** k}.0::DOUBLE ELSE 0.0 END AS {name}" for name, (n, d, k) in _R.items()) + """
    FROM (SELECT campaign_id, report_date, CAST(sum(impressions) AS BIGINT) AS impressions, CAST(sum(clicks) AS BIGINT) AS clicks,
                 CAST(sum(conversions) AS BIGINT) AS conversions, CAST(sum(revenue) AS DECIMAL(24,2)) AS revenue,
                 CAST(sum(spend) AS DECIMAL(24,2)) AS spend FROM raw_campaign_performance GROUP BY 1, 2) AS s""")
add("keyword_rank_changes", """
    SELECT *, position - previous_position AS position_change, CASE WHEN position <= 3 THEN 'top_3' WHEN position <= 10 THEN 'top_10'
           WHEN position <= 20 THEN 'top_20' WHEN position <= 50 THEN 'top_50' ELSE 'beyond' END AS bucket
    FROM (SELECT *, lag(position) OVER (PARTITION BY keyword_id ORDER BY rank_date) AS previous_position FROM raw_keyword_ranks) AS r""")
add("web_vitals_p95_exact", "SELECT date_trunc('hour', metric_ts) AS hour, count(*) AS samples, " + ", ".join(
    f"round(quantile_cont({c}, 0.95), 6) AS {c}_p95" for c in ("lcp", "fid", "cls")) + " FROM raw_web_vitals GROUP BY 1")
add("orders_by_country", "SELECT country_code, count(*) AS orders FROM clean_order_events GROUP BY 1")
add("order_item_totals", """
    SELECT o.order_id, o.total_amount, count(*) AS item_count, CAST(sum(CAST(quantity * unit_price AS DECIMAL(18,2))) AS DECIMAL(24,2)) AS items_total,
           abs(sum(CAST(quantity * unit_price AS DECIMAL(18,2))) - o.total_amount) < 0.01 AS matches
    FROM (SELECT CAST(order_bk AS BIGINT) AS order_id, total_amount FROM stg_orders) AS o JOIN raw_order_items_nested i ON i.order_id = o.order_id
    GROUP BY o.order_id, o.total_amount""")
add("session_rates", """
    SELECT *, CAST(bounces AS DOUBLE) / sessions AS bounce_rate, CAST(conversions AS DOUBLE) / sessions AS conversion_rate
    FROM (SELECT landing_page, CASE WHEN keyword LIKE '%buy%' THEN 'transactional' WHEN keyword LIKE '%brand%' THEN 'navigational'
                                    WHEN keyword LIKE '%how%' THEN 'informational' ELSE 'commercial' END AS keyword_class,
                 count(*) AS sessions, count(*) FILTER (WHERE pages_viewed <= 1) AS bounces, count(*) FILTER (WHERE conversion) AS conversions,
                 CAST(sum(revenue) AS DECIMAL(24,2)) AS revenue FROM raw_organic_sessions GROUP BY 1, 2) AS s""")
add("worked_time", """
    SELECT employee_id, CAST(ts AS DATE) AS work_date, count(*) AS shifts, CAST(sum(trunc(epoch(next_ts - ts))) AS BIGINT) AS worked_seconds
    FROM (SELECT *, lead(event_type) OVER w AS next_type, lead(ts) OVER w AS next_ts FROM raw_clock_events
          WINDOW w AS (PARTITION BY employee_id ORDER BY ts, event_id)) AS c
    WHERE event_type = 'clock_in' AND next_type = 'clock_out' GROUP BY 1, 2""")
VERSIONS["unit"] = """
    SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS norm FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings) AS d"""
add("vector_normalised", "SELECT vec_id, CAST(generate_subscripts(e, 1) - 1 AS INT) AS pos, round(unnest(e) / norm, 9) AS x FROM unit")
VERSIONS["means"] = """
    SELECT label, list(m ORDER BY pos) AS v FROM (SELECT label, pos, avg(x) AS m
      FROM (SELECT label, generate_subscripts(embedding, 1) AS pos, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings) AS e GROUP BY 1, 2) AS a GROUP BY label"""
add("vector_top_k", """
    SELECT query_id, vec_id, round(score, 6) AS score, CAST(rank AS INT) AS rank
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
          FROM (SELECT m.label AS query_id, u.vec_id,
                       list_inner_product(u.e, m.v) / u.norm / sqrt(list_inner_product(m.v, m.v)) AS score FROM means m, unit u) AS s) AS r
    WHERE rank <= 5""")
add("vector_neighbours", """
    SELECT query_id, vec_id, round(score, 6) AS score, CAST(rank AS INT) AS rank
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
          FROM (SELECT q.vec_id AS query_id, u.vec_id, round(list_inner_product(u.e, q.e) / u.norm / q.norm, 9) AS score
                FROM unit q, unit u WHERE q.vec_id % 20 = 0) AS s) AS r
    WHERE rank <= 5""")

# A table that is kept by loads equals the one that is built at once.
for _table in (*HUBS, *LINKS, *SATELLITES):
    add(f"loaded_{_table}", f"SELECT * FROM {_table}")
add("loaded_order_history", timeline("order_snapshots", "status, currency, total_amount, order_ts"))

for _name in ("fct_orders", "fct_daily_sales", "agg_daily_sales", "mart_daily_business_kpis", "mart_cohort_retention", "mv_customer_360", "pit_customer", "pit_order"):
    STATEMENTS[f"kept_{_name}"] = statement(f"SELECT * FROM {_name}")
