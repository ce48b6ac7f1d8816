"""Raw marketplace feeds as projections of the sample tables.

Each feed is a SELECT over one table in the SQL that Spark and other ANSI engines share.
A feed has the shape of a raw table: snapshots repeat a business id with a later
``ingested_at``, logs repeat a position when a message is delivered twice.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

_CURRENCY = ("CASE o_custkey % 5 WHEN 0 THEN 'usd' WHEN 1 THEN 'eur' WHEN 2 THEN 'gbp' "
             "WHEN 3 THEN 'jpy' ELSE 'rub' END")
_TOTAL = "CAST(o_totalprice AS DECIMAL(14,2))"

FEEDS: dict[str, str] = {
    "oltp_users": """
        SELECT c_custkey AS user_id,
               lower(replace(c_name, '#', '')) || '@' || lower(c_mktsegment) || '.com' AS email,
               CASE WHEN snap = 1 THEN upper(c_name) ELSE c_name END AS full_name,
               [TS] '1994-01-01 00:00:00' AS created_at,
               CASE WHEN snap = 1 THEN [TS] '1994-02-01 00:00:00' ELSE [TS] '1994-01-02 00:00:00' END AS ingested_at,
               'run-' || CAST(snap AS STRING) AS source_run_id
        FROM (SELECT *, [SNAPS] AS snap FROM [customer]) AS s
        WHERE snap = 0 OR c_mktsegment = 'BUILDING'""",
    "oltp_orders": f"""
        SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderdate AS order_ts,
               CASE WHEN snap = 0 THEN ' Created ' WHEN o_orderstatus = 'F' THEN ' Delivered' ELSE 'Paid ' END AS status,
               {_CURRENCY} AS currency_code,
               {_TOTAL} AS total_amount,
               CASE WHEN snap = 0 THEN o_orderdate + INTERVAL '1' HOUR ELSE o_orderdate + INTERVAL '1' DAY END AS ingested_at,
               CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE 'run-' || CAST(snap AS STRING) END AS source_run_id
        FROM (SELECT *, [SNAPS] AS snap FROM [orders]) AS s
        WHERE snap = 0 OR o_orderstatus <> 'O'""",
    "oltp_order_items": """
        SELECT CAST(l_orderkey AS STRING) || ':' || CAST(l_linenumber AS STRING) AS order_item_id,
               l_orderkey AS order_id, l_partkey AS product_id,
               CAST(l_quantity AS INT) AS quantity, CAST(l_extendedprice AS DECIMAL(12,2)) AS unit_price,
               l_shipdate AS ingested_at, 'run-0' AS source_run_id
        FROM [lineitem]""",
    "oltp_products": """
        SELECT p_partkey AS product_id, p_partkey % 97 AS seller_id,
               ' ' || lower(p_brand) || '-' || CAST(p_partkey AS STRING) AS sku,
               p_name AS product_name, p_type AS category,
               CAST(CAST(p_retailprice AS DECIMAL(12,2)) + snap AS DECIMAL(12,2)) AS price,
               CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_partkey % 3 <> 0 END AS is_active,
               [TS] '1994-01-01 00:00:00' AS created_at,
               CASE WHEN snap = 1 THEN [TS] '1994-03-01 00:00:00' ELSE [TS] '1994-01-02 00:00:00' END AS ingested_at,
               CAST(NULL AS STRING) AS source_run_id
        FROM (SELECT *, [SNAPS] AS snap FROM [part]) AS s
        WHERE snap = 0 OR p_size > 35""",
    "kafka_orders": f"""
        SELECT 'orders' AS topic, CAST(o_orderkey % 4 AS INT) AS partition_id, o_orderkey AS kafka_offset,
               CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE 'ord-' || CAST(o_orderkey AS STRING) END AS event_id,
               'order_created' AS event_type, o_orderkey AS order_id, o_custkey AS customer_id,
               {_TOTAL} AS total_amount, {_CURRENCY} AS currency,
               CASE o_custkey % 3 WHEN 0 THEN 'us' WHEN 1 THEN 'de' ELSE 'jp' END AS country_code,
               o_orderdate AS event_ts,
               CASE WHEN snap = 0 THEN o_orderdate + INTERVAL '1' MINUTE ELSE o_orderdate + INTERVAL '9' MINUTE END AS ingested_at
        FROM (SELECT *, [SNAPS] AS snap FROM [orders]) AS s
        WHERE snap = 0 OR o_orderpriority = '2-HIGH'""",
    "kafka_payments": f"""
        SELECT 'payments' AS topic, CAST(o_orderkey % 4 AS INT) AS partition_id, o_orderkey AS kafka_offset,
               CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE 'pay-' || CAST(o_orderkey AS STRING) END AS event_id,
               'payment' AS event_type, o_orderkey AS payment_id, o_orderkey AS order_id,
               'tx-' || CAST(o_orderkey AS STRING) AS transaction_id,
               CAST(CASE WHEN o_orderkey % 10 = 6 THEN {_TOTAL} - 1 ELSE {_TOTAL} END AS DECIMAL(14,2)) AS amount,
               ' ' || {_CURRENCY} AS currency,
               CASE o_orderkey % 4 WHEN 0 THEN 'Card' WHEN 1 THEN 'PayPal' WHEN 2 THEN 'bank' ELSE ' Wallet' END AS payment_method,
               CASE o_orderkey % 10 WHEN 7 THEN 'Failed' WHEN 8 THEN 'declined' ELSE 'SUCCESS' END AS status,
               CASE WHEN o_orderkey % 10 = 8 THEN 'insufficient_funds' ELSE NULL END AS decline_reason,
               CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_orderdate + INTERVAL '1' DAY END AS event_ts,
               CASE WHEN snap = 0 THEN o_orderdate + INTERVAL '25' HOUR ELSE o_orderdate + INTERVAL '26' HOUR END AS ingested_at
        FROM (SELECT *, [SNAPS] AS snap FROM [orders]) AS s
        WHERE o_orderpriority <> '5-LOW' AND (snap = 0 OR o_orderpriority = '2-HIGH')""",
    "file_payments": f"""
        SELECT 'payments/batch.jsonl::' || CAST(o_orderkey AS STRING) AS event_uuid,
               'payments/batch.jsonl' AS source_file, o_orderkey AS payment_id, o_orderkey AS order_id,
               {_TOTAL} AS amount, {_CURRENCY} AS currency, 'Success ' AS status,
               o_orderdate + INTERVAL '2' DAY AS event_ts, o_orderdate + INTERVAL '49' HOUR AS loaded_at
        FROM [orders] WHERE o_orderpriority = '1-URGENT'""",
    "oltp_marketing_campaigns": """
        SELECT p_partkey AS campaign_id, p_name AS campaign_name, p_type AS campaign_type,
               CASE p_partkey % 6 WHEN 0 THEN ' email ' WHEN 1 THEN 'search' WHEN 2 THEN 'social' WHEN 3 THEN ''
                    WHEN 4 THEN NULL ELSE 'display' END AS channel,
               CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE CAST(p_retailprice AS DECIMAL(12,2)) END AS budget,
               'EUR' AS currency,
               CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE DATE '2001-01-01' + CAST(p_partkey % 200 AS INT) END AS start_date,
               DATE '2001-02-01' + CAST(p_partkey % 200 AS INT) AS end_date,
               '{"size": ' || CAST(p_size AS STRING) || ', "age": "18-35"}' AS target_audience,
               CASE p_partkey % 3 WHEN 0 THEN 'active' WHEN 1 THEN ' paused' ELSE '' END AS status,
               'user-' || CAST(p_partkey % 5 AS STRING) AS created_by,
               [TS] '2001-01-01 00:00:00' AS created_at,
               CASE WHEN p_partkey % 2 = 0 THEN NULL ELSE [TS] '2001-02-01 00:00:00' END AS updated_at,
               CASE WHEN snap = 1 THEN [TS] '2001-02-03 00:00:00' ELSE [TS] '2001-02-02 00:00:00' END AS ingested_at,
               'run-' || CAST(snap AS STRING) AS source_run_id
        FROM (SELECT *, [SNAPS] AS snap FROM [part]) AS s
        WHERE snap = 0 OR p_size < 8""",
    "oltp_seo_keywords": """
        SELECT p_partkey AS keyword_id, ' ' || upper(p_name) AS keyword, p_type AS keyword_category,
               'https://shop.example/' || CAST(p_partkey AS STRING) AS target_url,
               p_size * 100 + snap AS search_volume,
               CAST('0.' || lpad(CAST(p_partkey % 100 AS STRING), 2, '0') AS DECIMAL(3,2)) AS competition_score,
               CAST(p_retailprice AS DECIMAL(8,2)) AS cpc_estimate, 'USD' AS currency,
               p_size AS current_rank, p_size % 10 + 1 AS target_rank,
               CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_partkey % 2 = 0 END AS is_tracked,
               [TS] '2001-01-01 00:00:00' AS created_at,
               CASE WHEN p_partkey % 2 = 0 THEN NULL ELSE [TS] '2001-02-01 00:00:00' END AS updated_at,
               CASE WHEN snap = 1 THEN [TS] '2001-02-03 00:00:00' ELSE [TS] '2001-02-02 00:00:00' END AS ingested_at,
               'run-' || CAST(snap AS STRING) AS source_run_id
        FROM (SELECT *, [SNAPS] AS snap FROM [part]) AS s
        WHERE snap = 0 OR p_size < 8""",
    "oltp_feature_flags": """
        SELECT s_suppkey AS flag_id,
               CASE WHEN s_suppkey % 25 = 0 THEN NULL ELSE ' Flag_' || CAST(s_suppkey AS STRING) END AS flag_key,
               s_name AS flag_name, 'Rollout of ' || s_name AS description,
               CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE s_suppkey % 2 = 1 END AS is_enabled,
               CAST((s_suppkey + snap) % 101 AS INT) AS rollout_percentage,
               '{"nation": ' || CAST(s_nationkey AS STRING) || ', "beta": true}' AS targeting_rules,
               [TS] '2001-01-01 00:00:00' AS created_at,
               CASE WHEN s_suppkey % 2 = 0 THEN NULL ELSE [TS] '2001-02-01 00:00:00' END AS updated_at,
               CASE WHEN snap = 1 THEN [TS] '2001-02-03 00:00:00' ELSE [TS] '2001-02-02 00:00:00' END AS ingested_at,
               'run-' || CAST(snap AS STRING) AS source_run_id
        FROM (SELECT *, [SNAPS] AS snap FROM [supplier]) AS s
        WHERE snap = 0 OR s_acctbal > 5000""",
    "oltp_employees": """
        SELECT c_custkey AS employee_id, ' emp-' || CAST(c_custkey AS STRING) AS employee_number,
               'Customer' AS first_name, ' ' || substr(c_name, 10) AS last_name,
               upper(replace(c_name, '#', '')) || '@SHOP.EXAMPLE' AS email,
               c_mktsegment AS department, CASE WHEN c_custkey % 6 = 0 THEN ' ' ELSE 'Agent' END AS job_title,
               'L' || CAST(c_custkey % 5 AS STRING) AS level, CAST(c_custkey % 10 AS INT) AS manager_id,
               DATE '1995-01-01' + CAST(c_custkey % 1000 AS INT) AS hire_date,
               CASE WHEN c_custkey % 9 = 0 THEN DATE '2000-01-01' ELSE NULL END AS termination_date,
               CASE WHEN c_custkey % 9 = 0 THEN 'terminated' ELSE 'active' END AS employment_status,
               'NATION_' || CAST(c_nationkey AS STRING) AS location, 'hybrid' AS remote_status,
               CAST(abs(c_acctbal) AS DECIMAL(12,2)) AS salary, 'EUR' AS currency,
               [TS] '2001-01-01 00:00:00' AS created_at,
               CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE [TS] '2001-02-01 00:00:00' END AS updated_at,
               CASE WHEN snap = 1 THEN [TS] '2001-02-03 00:00:00' ELSE [TS] '2001-02-02 00:00:00' END AS ingested_at,
               'run-' || CAST(snap AS STRING) AS source_run_id
        FROM (SELECT *, [SNAPS] AS snap FROM [customer]) AS s
        WHERE snap = 0 OR c_acctbal < 1000""",
    "oltp_general_ledger": f"""
        SELECT o_orderkey * 2 + snap AS entry_id, CAST(o_orderdate AS DATE) AS entry_date,
               'je-' || CAST(o_orderkey AS STRING) || CASE WHEN snap = 0 THEN '-d' ELSE '-c' END AS entry_number,
               CASE WHEN snap = 0 THEN '1100' ELSE '4000' END AS account_code,
               CASE WHEN snap = 0 THEN 'Receivables' ELSE 'Revenue' END AS account_name,
               CASE WHEN snap = 0 THEN 'asset' ELSE 'income' END AS account_type,
               CAST(CASE WHEN snap = 0 THEN {_TOTAL} ELSE NULL END AS DECIMAL(15,2)) AS debit_amount,
               CAST(CASE WHEN snap = 1 THEN {_TOTAL} - CASE WHEN o_orderkey % 1000 = 0 THEN 1 ELSE 0 END
                         ELSE NULL END AS DECIMAL(15,2)) AS credit_amount,
               'EUR' AS currency, 'sale' AS transaction_type, o_orderkey AS reference_id, ' order' AS reference_type,
               'Order ' || CAST(o_orderkey AS STRING) AS description, 'system' AS posted_by,
               o_orderdate AS created_at, o_orderdate + INTERVAL '1' HOUR AS ingested_at, '' AS source_run_id
        FROM (SELECT *, [SNAPS] AS snap FROM [orders]) AS s""",
    "kafka_extension_events": """
        SELECT 'ext.' || event_type AS topic, CAST(user_id % 4 AS INT) AS partition_id, event_id AS kafka_offset,
               'web' AS domain_code,
               CASE event_id % 10 WHEN 0 THEN NULL WHEN 1 THEN ' ' ELSE 'ev-' || CAST(event_id AS STRING) END AS event_id,
               event_type, props AS payload,
               CASE WHEN event_id % 33 = 0 THEN NULL ELSE ts END AS event_ts,
               CASE WHEN snap = 0 THEN ts + INTERVAL '10' SECOND ELSE ts + INTERVAL '70' SECOND END AS ingested_at
        FROM (SELECT *, [SNAPS] AS snap FROM [events]) AS s
        WHERE snap = 0 OR event_type = 'error'""",
    "user_state_log": """
        SELECT CAST(user_id AS STRING) AS hub_key, event_type AS hashdiff, ts AS load_dts, ts AS effective_from,
               'events' AS record_source, value, event_id,
               CASE WHEN extract(SECOND FROM ts) >= 40 THEN 2 ELSE 1 END AS batch
        FROM [events]""",
    "order_messages": f"""
        SELECT 'orders' AS topic, CAST(o_orderkey % 4 AS INT) AS partition, o_orderkey AS [OFFSET],
               o_orderdate + INTERVAL '5' MINUTE AS timestamp,
               CASE WHEN o_orderpriority = '5-LOW' THEN 'not json ' || CAST(o_orderkey AS STRING)
                    WHEN o_orderpriority = '1-URGENT'
                    THEN '{{"event_id":"o-' || CAST(o_orderkey AS STRING) || '","event_type":"order_created","order_id":' ||
                         CAST(o_orderkey AS STRING) || ',"user_id":' || CAST(o_custkey AS STRING) || ',"amount":' ||
                         CAST({_TOTAL} AS STRING) || ',"currency":"EURO","country_code":"","ts":"' ||
                         CAST(CAST(o_orderdate AS DATE) AS STRING) || 'T08:30:00Z"}}'
                    WHEN o_orderpriority = '2-HIGH'
                    THEN '{{"event_id":"o-' || CAST(o_orderkey AS STRING) || '","order_id":' || CAST(o_orderkey AS STRING) ||
                         ',"customer_id":' || CAST(o_custkey AS STRING) || ',"total_amount":' || CAST({_TOTAL} AS STRING) ||
                         ',"currency":"","country_code":"USA","timestamp":' || CAST(1500000000000 + o_orderkey AS STRING) || '}}'
                    WHEN o_orderpriority = '3-MEDIUM'
                    THEN '{{"event_id":"o-' || CAST(o_orderkey AS STRING) || '","order_id":' || CAST(o_orderkey AS STRING) ||
                         ',"customer_id":' || CAST(o_custkey AS STRING) || ',"total_amount":-1.00,"event_ts":' ||
                         CAST(1500000000 + o_orderkey AS STRING) || ',"currency":"usd"}}'
                    ELSE '{{"event_id":"","order_id":' || CAST(o_orderkey AS STRING) || ',"currency":"US","timestamp":"garbage"}}'
               END AS value
        FROM [orders]""",
    "payment_messages": f"""
        SELECT 'payments' AS topic, CAST(o_orderkey % 4 AS INT) AS partition, o_orderkey AS [OFFSET],
               o_orderdate + INTERVAL '5' MINUTE AS timestamp,
               '{{"event_id":"p-' || CAST(o_orderkey AS STRING) || '","event_type":"payment","payment_id":' ||
               CAST(o_orderkey AS STRING) || ',"order_id":' || CAST(o_orderkey AS STRING) || ',"transaction_id":"tx-' ||
               CAST(o_orderkey AS STRING) || '","amount":' || CAST({_TOTAL} AS STRING) || ',"currency":"EUR","payment_method":"card",' ||
               CASE WHEN o_orderstatus = 'P' THEN '"status":"DECLINED","decline_reason":"limit",' ELSE '"status":"CAPTURED",' END ||
               '"timestamp":' || CAST(1500000000000 + o_orderkey * 1000 AS STRING) || '}}' AS value
        FROM [orders]""",
    "change_messages": """
        SELECT 'cdc.users' AS topic, CAST(user_id % 4 AS INT) AS partition, event_id AS [OFFSET], ts AS timestamp,
               CASE event_type
                 WHEN 'error' THEN '{"before":{"user_id":' || CAST(user_id AS STRING) || '},"after":null,"op":"d","ts_ms":' ||
                                   CAST(event_id AS STRING) || '}'
                 ELSE '{"before":null,"after":{"user_id":' || CAST(user_id AS STRING) || ',"state":"' || event_type ||
                      '","value":' || CAST(CAST(value AS DECIMAL(12,2)) AS STRING) || '},"op":"' ||
                      CASE event_type WHEN 'signup' THEN 'c' WHEN 'view' THEN 'r' ELSE 'u' END || '","ts_ms":' ||
                      CAST(event_id AS STRING) || '}' END AS value
        FROM [events]""",
    "pipeline_runs": """
        SELECT 'run-' || CAST(event_id AS STRING) AS run_id, 'dag_' || event_type AS dag_id, 'task' AS task_id,
               'source_' || CAST(user_id % 5 AS STRING) AS source,
               CASE user_id % 3 WHEN 0 THEN 'ingestion' WHEN 1 THEN 'transformation' ELSE 'marts' END AS layer,
               CASE WHEN event_type = 'error' THEN 'failed' WHEN event_id % 17 = 0 THEN 'running' ELSE 'success' END AS status,
               ts AS started_at,
               CASE WHEN event_id % 17 = 0 THEN NULL ELSE ts + INTERVAL '90' SECOND END AS finished_at,
               CASE WHEN event_id % 17 = 0 THEN NULL ELSE event_id % 1000 END AS rows_in,
               CASE WHEN event_id % 17 = 0 THEN NULL ELSE event_id % 900 END AS rows_out,
               CAST(event_id % 3 AS BIGINT) AS rows_quarantined,
               CASE WHEN event_type = 'error' THEN 'failed at ' || CAST(event_id AS STRING) ELSE NULL END AS error_message,
               props AS payload
        FROM [events]""",
    "order_items_nested": """
        SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_partkey AS product_id,
               CAST(l_quantity AS INT) AS quantity, CAST(l_extendedprice AS DECIMAL(12,2)) AS unit_price
        FROM [lineitem]""",
    "campaign_performance": """
        SELECT l_suppkey AS campaign_id, CAST(l_shipdate AS DATE) AS report_date,
               CAST(l_quantity AS BIGINT) * 100 AS impressions,
               CAST(l_quantity AS BIGINT) % 7 AS clicks, CAST(l_quantity AS BIGINT) % 3 AS conversions,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS revenue, CAST(l_quantity AS DECIMAL(12,2)) AS spend
        FROM [lineitem]""",
    "keyword_ranks": """
        SELECT l_partkey AS keyword_id, CAST(l_shipdate AS DATE) AS rank_date,
               min(CAST(l_quantity AS INT)) AS position
        FROM [lineitem] GROUP BY l_partkey, CAST(l_shipdate AS DATE)""",
    "web_vitals": """
        SELECT event_id AS metric_id, ts AS metric_ts, value AS lcp, value / 10 AS fid,
               CASE WHEN event_id % 40 = 0 THEN NULL ELSE value / 100 END AS cls
        FROM [events]""",
    "clock_events": """
        SELECT user_id AS employee_id, event_id,
               CASE WHEN event_type IN ('click', 'signup') THEN 'clock_in' ELSE 'clock_out' END AS event_type, ts
        FROM [events]""",
    "organic_sessions": """
        SELECT event_id, 'https://shop.example/' || event_type AS landing_page,
               CASE event_id % 4 WHEN 0 THEN 'buy phone' WHEN 1 THEN 'brand store' WHEN 2 THEN 'how to choose tv'
                    ELSE 'tablet review' END AS keyword,
               CAST(floor(value) AS INT) % 6 + 1 AS pages_viewed, event_type = 'purchase' AS conversion,
               CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(12,2)) ELSE NULL END AS revenue
        FROM [events]""",
}

_SPARK = {"TS": "TIMESTAMP_NTZ", "SNAPS": "explode(array(0, 1))", "OFFSET": "offset"}
_ANSI = {"TS": "TIMESTAMP", "SNAPS": "unnest([0, 1])", "OFFSET": '"offset"', **{t: t for t in TABLES}}


def _fill(text: str, names: dict[str, str]) -> str:
    for name, value in names.items():
        text = text.replace(f"[{name}]", value)
    return text


def feed(spark: SparkSession, directory: str, name: str) -> DataFrame:
    files = {t: f"parquet.`{directory}/{t}.parquet`" for t in TABLES}
    return spark.sql(_fill(FEEDS[name], {**_SPARK, **files}))


def feed_over(table: DataFrame, name: str, source: str) -> DataFrame:
    """A feed over an already opened table, which may be a stream."""
    view = f"{source}_{uuid.uuid4().hex}"
    table.createOrReplaceTempView(view)
    rows = table.sparkSession.sql(_fill(FEEDS[name], {**_SPARK, source: view}))
    table.sparkSession.catalog.dropTempView(view)
    return rows


def feed_sql(name: str) -> str:
    """The same projection as text over views named like the tables."""
    return _fill(FEEDS[name], _ANSI)


def sample(spark: SparkSession, directory: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{table}.parquet")
