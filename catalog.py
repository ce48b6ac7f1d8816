"""Registered queries: name -> (session, folder with the sample tables) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.hashing import digest, key_text, packed, plain_hash, plain_key, unpacked
from millrace.functions.payloads import (extension_rows, file_payment_rows, message_projection, order_rows,
                                         payment_rows)
from millrace.meta import runs, watermarks
from millrace.meta.lag import ingestion_lag, offset_lag
from millrace.meta.watermarks import last_offsets, merged_offsets
from millrace.ml.order_value import TrainingSpec, train
from millrace.operators.bridge import build_bridge
from millrace.operators.contracts import CLEAN_ORDER, ORDER_EVENT, PAYMENT_EVENT, split, with_violations
from millrace.operators.keys import hub_rows, link_rows
from millrace.operators.latest import latest_by
from millrace.operators.merge import incremental_refresh, insert_absent, upsert
from millrace.operators.pit import build_pit, refresh_pit
from millrace.operators.scd2 import (SatSpec, build_satellite, close_and_insert, end_date_only, first_versions,
                                     load_satellite, lossless_timeline, new_versions)
from millrace.operators.union import union_all
from millrace.plans import dashboards, finance, marketplace, serving
from millrace.plans.incremental import DailyMarts
from millrace.plans.loads import PitTable, SatelliteTable, VaultTable, key_columns, vault_table
from millrace.plans.marts import kpi_snapshot
from millrace.plans.staging import ingest_slice, orders_shape
from millrace.plans.vault import HUBS, LINKS, SATELLITES, row_counts
from millrace.plans.warehouse import TABLES, Clock, Warehouse, digested, keyed
from millrace.quality import invariants
from millrace.quality.checks import CheckSpec, duplicates, evaluate, execute_checks, failing_rows, wrong_current
from millrace.quality.freshness import (EXTENSION, KAFKA, OLTP, Freshness, freshness, layer_counts, offenders)
from millrace.session import apply_defaults
from millrace.sources import files
from millrace.sources.extract import SOURCES, Cursor, extract_page
from millrace.sources.feeds import feed_over, sample
from millrace.sources.landing import Prefix, load_all, new_logs, newest_manifest
from millrace.sources.batches import BatchLog
from millrace.streaming.changes import STATE as CHANGE_STATE
from millrace.streaming.changes import (change_state, collect_changes, collect_rows, file_stream, first_deliveries,
                                        live_rows, newest_state, satellite_of)
from millrace.streaming.ingest import load_messages
from millrace.vector.many import top_k_many
from millrace.vector.search import l2_normalise, label_centroids, top_k

Query = Callable[[SparkSession, str], DataFrame]

CLOCK = Clock(now=datetime(2001, 8, 2))

_warehouses: dict[tuple[str, str], Warehouse] = {}


def warehouse(spark: SparkSession, directory: str) -> Warehouse:
    """One warehouse per application and input folder."""
    key = (spark.sparkContext.applicationId, directory)
    if key not in _warehouses:
        _warehouses[key] = Warehouse(spark, directory, CLOCK)
    return _warehouses[key]


QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = f
        return f
    return register


def prepared(name: str) -> Query:
    def run(spark: SparkSession, directory: str) -> DataFrame:
        apply_defaults(spark)
        return QUERIES[name](spark, directory)
    return run


def _table_query(name: str) -> Query:
    return lambda spark, directory: warehouse(spark, directory).frame(name)


for _name in TABLES:
    QUERIES[_name] = _table_query(_name)


# --- versions: two loads of an event log, the second with late rows everywhere -----------

STATE = SatSpec("user_state", "user_state_log", ("value", "event_id"))
EVENTS_NOW = datetime(2024, 1, 31)


def _batch(wh: Warehouse, number: int) -> DataFrame:
    return wh.raw("user_state_log").filter(F.col("batch") == number).drop("batch")


def _first_load(wh: Warehouse) -> DataFrame:
    return wh.stored("user_state_1", lambda: build_satellite(_batch(wh, 1), STATE))


def _second_load(wh: Warehouse) -> DataFrame:
    return wh.stored("user_state_2", lambda: load_satellite(_first_load(wh), _batch(wh, 2), STATE))


def _warehouse_query(name: str) -> Callable[[Callable[[Warehouse], DataFrame]], Callable]:
    def register(f: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
        query(name)(lambda spark, directory: f(warehouse(spark, directory)))
        return f
    return register


def _work_dir(w: Warehouse, name: str) -> str:
    """A folder of its own per run, so that a repeated query starts from nothing."""
    return f"{w.root}/streams/{name}-{uuid.uuid4().hex}"


def on_warehouse(name: str, f: Callable[[Warehouse], DataFrame]) -> None:
    _warehouse_query(name)(f)


on_warehouse("sat_first_load", lambda w: build_satellite(_batch(w, 1), STATE))
on_warehouse("sat_late_delta", lambda w: new_versions(_batch(w, 2), _first_load(w), STATE))
on_warehouse("sat_merge_detector", lambda w: new_versions(_batch(w, 2), _first_load(w), STATE, dedupe=False))
on_warehouse("sat_after_late_load", lambda w: load_satellite(_first_load(w), _batch(w, 2), STATE))
on_warehouse("sat_end_dated", lambda w: end_date_only(first_versions(w.raw("user_state_log"), STATE)))
on_warehouse("sat_lossless", lambda w: lossless_timeline(w.raw("user_state_log").drop("batch"), STATE))


def _two_loads(w: Warehouse, spec) -> tuple[DataFrame, DataFrame]:
    """Two thirds of the keys, then all rows."""
    staged = w.plain(spec.source)
    return staged.filter(F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in key_columns(spec)]), F.lit(3)) > 0), staged


def _loaded(w: Warehouse, name: str) -> DataFrame:
    """A vault table after two loads, the second of them run again, read by a new object. It is kept by key texts."""
    spec = {**HUBS, **LINKS, **SATELLITES}[name]
    path = _work_dir(w, f"loads-{name}")
    table = vault_table(w.spark, path, spec, key_text)
    early, staged = _two_loads(w, spec)
    stored, read = (packed, unpacked) if name in SATELLITES else (lambda rows: rows, lambda rows: rows)
    for number, rows in ((1, early), (2, staged), (2, staged)):
        table.load(stored(rows), number)
    return digested(name, read(vault_table(w.spark, path, spec, key_text).rows()))


for _name in (*HUBS, *LINKS, *SATELLITES):
    on_warehouse(f"loaded_{_name}", lambda w, name=_name: _loaded(w, name))


def _kept_pit(w: Warehouse, hub: str, sat: str) -> DataFrame:
    """A point-in-time table after two loads of its satellite, then moved on by three days."""
    spec = SATELLITES[sat]
    table = SatelliteTable(w.spark, _work_dir(w, f"pit-{sat}"), spec, buckets=4)
    pit = PitTable(w.spark, _work_dir(w, f"kept-pit-{sat}"), [(sat, table)], w.clock.pit_days)
    for days_ago, rows in zip((3, 0), _two_loads(w, spec)):
        changed = table.load(rows)
        pit.refresh(changed, w.plain(hub) if days_ago == 0 else changed, w.clock.today - timedelta(days=days_ago))
    return pit.rows(digest)


on_warehouse("kept_pit_customer", lambda w: _kept_pit(w, "hub_customers", "sat_customer_details"))
on_warehouse("kept_pit_order", lambda w: _kept_pit(w, "hub_orders", "sat_order_status"))


# --- facts and marts kept by loads: old versions of some orders first, then corrections and late orders ---

_kept: dict[str, DailyMarts] = {}


def _kept_marts(w: Warehouse) -> DailyMarts:
    """Four fifths of the orders, a quarter of them with another day, amount, state or customer; then the rest and the corrections.
    Payments come before their orders, first with other states."""
    if w.root not in _kept:
        orders, payments = w.plain("fct_orders"), w.plain("fct_payments")
        kept = DailyMarts(w.spark, _work_dir(w, "kept-marts"), orders.schema, buckets=4, grain="year")
        part, old = F.pmod(F.xxhash64("order_hub_key"), F.lit(5)), F.pmod(F.xxhash64("order_hub_key"), F.lit(10)) == 1
        other = orders.filter(part == 1).withColumns({
            "order_ts": F.col("order_ts") - F.expr("INTERVAL 40 DAY"), "order_date": F.date_sub("order_date", 40), "payment_state": F.lit("unpaid"),
            "total_amount": (F.col("total_amount") + 10).cast(orders.schema["total_amount"].dataType),
            "customer_hub_key": F.when(old, F.concat("customer_hub_key", F.lit("x"))).otherwise(F.col("customer_hub_key"))})
        early = F.pmod(F.xxhash64("payment_hub_key"), F.lit(3))
        kept.load_payments(payments.filter(early > 0).withColumn("status", F.when(early == 1, F.lit("failed")).otherwise(F.col("status"))))
        kept.load(orders.filter(part > 1).unionByName(other))
        kept.load(orders.filter(part <= 1))
        kept.load_payments(payments.filter(early <= 1))
        _kept[w.root] = kept
    return _kept[w.root]


for _name in ("fct_orders", "fct_daily_sales", "agg_daily_sales", "mart_daily_business_kpis", "mart_cohort_retention"):
    on_warehouse(f"kept_{_name}", lambda w, name=_name: digested(name, getattr(_kept_marts(w), name)()))
on_warehouse("kept_mv_customer_360", lambda w: digested("mv_customer_360", _kept_marts(w).mv_customer_360(w.plain("dim_customers"))))


@_warehouse_query("loaded_order_history")
def _loaded_order_history(w: Warehouse) -> DataFrame:
    """Every order snapshot as an observation, in three loads that come in no order of time."""
    spec = SatSpec("sat_order_history", "oltp_orders", SATELLITES["sat_order_status"].columns)
    snapshots = keyed("stg_orders", orders_shape(w.raw("oltp_orders")))
    table = SatelliteTable(w.spark, _work_dir(w, "loads-order-history"), spec, buckets=4)
    part = F.pmod(F.xxhash64("hub_key", "hashdiff", "effective_from"), F.lit(3))
    for number in (2, 0, 1):
        table.load(packed(snapshots.filter(part == number)), number)
    return digested("sat_order_history", unpacked(table.rows()))


on_warehouse("sat_order_history", lambda w: digested("sat_order_history", unpacked(build_satellite(
    packed(keyed("stg_orders", orders_shape(w.raw("oltp_orders")))), SatSpec(
        "sat_order_history", "oltp_orders", SATELLITES["sat_order_status"].columns)))))


def _newest_per_user(rows: DataFrame) -> DataFrame:
    return latest_by(rows, ["hub_key"], [F.col("effective_from").desc(), F.col("hashdiff").asc()])


on_warehouse("sat_close_and_insert", lambda w: close_and_insert(
    build_satellite(_newest_per_user(_batch(w, 1)), STATE), _newest_per_user(_batch(w, 2)), STATE.columns))


def _plain_orders(w: Warehouse) -> DataFrame:
    return w.frame("clean_orders")


on_warehouse("plain_hub_orders", lambda w: _plain_orders(w).select(
    plain_key(F.col("order_id")).alias("order_hk"), F.col("order_id").cast("string").alias("order_bk")).distinct())
on_warehouse("plain_link_customer_orders", lambda w: _plain_orders(w).select(
    plain_key(F.concat(F.col("customer_id").cast("string"), F.lit("||"), F.col("order_id").cast("string")))
    .alias("link_hk"), plain_key(F.col("customer_id")).alias("customer_hk"),
    plain_key(F.col("order_id")).alias("order_hk")).distinct())
on_warehouse("plain_sat_order_status", lambda w: _plain_orders(w).select(
    plain_key(F.col("order_id")).alias("order_hk"), F.col("order_ts").alias("effective_from"),
    plain_hash(F.col("status"), F.col("total_amount"), F.col("currency_code")).alias("hash_diff"),
    "status", "total_amount", F.col("currency_code").alias("currency")))
on_warehouse("vault_row_counts", lambda w: row_counts({n: w.table(n) for n in (
    "hub_customers", "hub_orders", "link_customer_order", "sat_customer_details", "sat_order_status")}))
on_warehouse("hub_increment", lambda w: hub_rows(
    w.table("stg_orders"), HUBS["hub_orders"],
    existing=w.table("hub_orders").filter(F.col("load_dts") < F.lit(datetime(2000, 1, 1)))))
on_warehouse("link_increment", lambda w: link_rows(
    w.table("stg_orders"), LINKS["link_customer_order"],
    existing=w.table("link_customer_order").filter(F.col("load_dts") < F.lit(datetime(2000, 1, 1)))))
on_warehouse("pit_user_state", lambda w: build_pit(
    _second_load(w).select("hub_key").distinct(), [("state", _second_load(w)), ("first", _first_load(w))],
    EVENTS_NOW.date(), 30))


@_warehouse_query("pit_increment")
def _pit_increment(w: Warehouse) -> DataFrame:
    """A table that ends six days earlier and does not know every user, brought up to date."""
    users = _second_load(w).select("hub_key").distinct()
    versions = [("state", _second_load(w))]
    existing = build_pit(users.filter(F.col("hub_key") < "5"), versions, date(2024, 1, 25), 24)
    return refresh_pit(existing, users, versions, EVENTS_NOW.date(), 30)


on_warehouse("bridge_generic", lambda w: build_bridge(
    w.plain("link_order_payment"), {"order": w.plain("hub_orders"), "payment": w.plain("hub_payments")}, key=digest))

# --- merging ------------------------------------------------------------------------------

CUT = datetime(2000, 1, 1)


def _old_orders(w: Warehouse) -> DataFrame:
    return w.frame("clean_orders").filter(F.col("order_ts") < F.lit(CUT))


on_warehouse("upsert_orders", lambda w: upsert(
    _old_orders(w), w.frame("clean_orders").filter((F.col("total_amount") >= 100000) | (F.col("order_ts") >= F.lit(CUT))).select(
        "order_id", F.lit("audited").alias("status")), ["order_id"], ["status"]))
on_warehouse("insert_absent_orders", lambda w: insert_absent(
    _old_orders(w).select("order_id", "status"), w.raw("oltp_orders").select(
        "order_id", F.lit("new").alias("status")), ["order_id"]))
on_warehouse("replace_daily_sales", lambda w: incremental_refresh(
    w.table("fct_daily_sales").filter(F.col("order_date") <= F.lit(CUT.date())).withColumn("order_count", F.lit(0)),
    w.table("fct_daily_sales"), ["order_date", "currency"], "order_date", 7))
on_warehouse("evolved_union", lambda w: union_all([
    w.table("hub_orders"), w.table("link_customer_order").select("load_dts", "record_source", "link_key")], evolve=True))
on_warehouse("kpi_snapshot", lambda w: kpi_snapshot({
    "daily_sales_gross": (w.table("fct_daily_sales").filter(F.col("order_date") == F.lit(CLOCK.today)).agg(
        F.sum("gross_sales").alias("value")), "numeric"),
    "active_customers_30d": (dashboards.last_days(w.plain("fct_orders"), "order_date", CLOCK.today, 30).agg(
        F.countDistinct("customer_hub_key").alias("value")), "integer"),
    "top_currency": (dashboards.top_groups(w.table("fct_orders"), "currency", F.count(F.lit(1)), 1).select(
        F.col("currency").alias("value")), "text")}))

# --- finance ------------------------------------------------------------------------------


def _rates(w: Warehouse) -> DataFrame:
    """A rate per order date for two of the currencies, taken from the dates themselves."""
    dates = finance.rate_dates(w.table("fct_daily_sales"), w.table("fct_orders"))
    usd = dates.select(F.col("order_date").alias("rate_date"), F.lit("USD").alias("currency"),
                       (F.dayofmonth("order_date") / 2.0 + 60).alias("rate_to_rub"))
    eur = usd.withColumns({"currency": F.lit("EUR"), "rate_to_rub": F.col("rate_to_rub") + 10})
    return usd.unionByName(eur)


def _dated(w: Warehouse, table: str) -> DataFrame:
    return w.table(table).filter(F.col("order_date").isNotNull())


on_warehouse("rate_dates", lambda w: finance.rate_dates(w.table("fct_daily_sales"), w.table("fct_orders")))
on_warehouse("mart_daily_finance_rub", lambda w: finance.mart_daily_finance_rub(
    _dated(w, "fct_daily_sales"), _rates(w), "20010802_000000"))
on_warehouse("mart_order_mix_rub", lambda w: finance.mart_order_mix_rub(
    _dated(w, "fct_orders"), _rates(w), "20010802_000000"))

# --- dashboards ---------------------------------------------------------------------------

KPIS, COHORTS, CATEGORIES = "mart_daily_business_kpis", "mart_cohort_retention", "mart_category_performance"
on_warehouse("panel_gmv_today", lambda w: dashboards.gmv_today(w.table(KPIS), CLOCK.today))
on_warehouse("panel_net_revenue_30d", lambda w: dashboards.net_revenue_30d(w.table(KPIS), CLOCK.today))
on_warehouse("panel_aov_30d", lambda w: dashboards.aov_30d(w.table(KPIS), CLOCK.today))
on_warehouse("panel_d30_retention", lambda w: dashboards.d30_retention(w.table(COHORTS), CLOCK.today))
on_warehouse("panel_gmv_trend_60d", lambda w: dashboards.sums_over_time(
    w.table(KPIS), "metric_date", {"gmv": "gmv", "net_revenue": "net_revenue"}, CLOCK.today, 60))
on_warehouse("panel_new_repeat_60d", lambda w: dashboards.sums_over_time(
    w.table(KPIS), "metric_date", {"new_buyers": "new_buyers_count", "repeat_buyers": "repeat_buyers_count"},
    CLOCK.today, 60))
on_warehouse("panel_top_categories", lambda w: dashboards.top_categories_30d(w.table(CATEGORIES), CLOCK.today))
on_warehouse("panel_channel_budget_90d", lambda w: dashboards.sums_over_time(
    w.table("mart_marketing_channel"), "metric_date", {"value": "planned_budget"}, CLOCK.today, 90, ("channel",)))
on_warehouse("panel_unit_economics", lambda w: dashboards.unit_economics_table(w.table("mart_unit_economics")))

# Single-number and group charts as (table, group column, measure, row limit).
NUMBER_CHARTS = {
    "chart_gross_sales": ("fct_daily_sales", "sum", "gross_sales"),
    "chart_product_count": ("dim_products", "count", None),
    "chart_average_price": ("dim_products", "avg", "price"),
    "chart_order_count": ("fct_orders", "count", None),
    "chart_order_amount": ("fct_orders", "sum", "total_amount"),
    "chart_customer_count": ("mv_customer_360", "count", None),
    "chart_spend_90d": ("mv_customer_360", "sum", "spend_90d"),
    "chart_gmv": (KPIS, "sum", "gmv"),
    "chart_net_revenue": (KPIS, "sum", "net_revenue"),
    "chart_orders": (KPIS, "sum", "orders_count"),
    "chart_gross_sales_rub": ("mart_daily_finance_rub", "sum", "gross_sales_rub"),
    "chart_mix_orders": ("mart_order_mix_rub", "sum", "order_count"),
}
GROUP_CHARTS = {
    "chart_days_by_currency": ("fct_daily_sales", "currency", "count", None, 100),
    "chart_sales_by_currency": ("fct_daily_sales", "currency", "sum", "gross_sales", 50),
    "chart_orders_by_state": ("fct_orders", "payment_state", "count", None, 50),
    "chart_products_by_category": ("dim_products", "category", "count", None, 200),
    "chart_customers_by_segment": ("dim_customers", "customer_segment", "count", None, 200),
    "chart_customers_by_domain": ("dim_customers", "email_domain", "count", None, 50),
    "chart_snapshot_sum": ("serving_snapshot", "metric_key", "sum", "metric_value_num", 50),
    "chart_snapshot_max": ("serving_snapshot", "metric_key", "max", "metric_value_num", 20),
    "chart_segments_360": ("mv_customer_360", "customer_segment", "count", None, 50),
    "chart_revenue_by_category": (CATEGORIES, "category", "sum", "gross_revenue", 100),
    "chart_rub_by_currency": ("mart_daily_finance_rub", "currency", "sum", "gross_sales_rub", 100),
    "chart_rub_by_state": ("mart_order_mix_rub", "payment_state", "sum", "revenue_rub", 100),
    "chart_mix_by_currency": ("mart_order_mix_rub", "currency", "sum", "revenue_rub", 100),
}
TIME_CHARTS = {
    "chart_sales_by_day": ("fct_daily_sales", "order_date", {"gross_sales": "gross_sales"}),
    "chart_paid_unpaid_by_day": ("fct_daily_sales", "order_date",
                                 {"paid_sales": "paid_sales", "unpaid_sales": "unpaid_sales"}),
    "chart_gmv_by_day": (KPIS, "metric_date", {"gmv": "gmv", "net_revenue": "net_revenue"}),
    "chart_rub_by_day": ("mart_daily_finance_rub", "order_date", {"gross_sales_rub": "gross_sales_rub"}),
}


def _chart_table(w: Warehouse, name: str) -> DataFrame:
    finance_tables = ("mart_daily_finance_rub", "mart_order_mix_rub")
    return w.stored(name, lambda: QUERIES[name](w.spark, w.directory)) if name in finance_tables else w.table(name)


def _measure(kind: str, column: str | None) -> F.Column:
    if kind == "count":
        return F.count(F.lit(1)).cast("double")
    if kind == "avg":
        return F.sum(column).cast("double") / F.count(column).cast("double")
    if kind == "max":
        return F.max(column).cast("double")
    return F.round(F.sum(column).cast("double"), 3)


def _register_charts() -> None:
    for name, (table, kind, column) in NUMBER_CHARTS.items():
        on_warehouse(name, lambda w, t=table, k=kind, c=column: dashboards.number(_chart_table(w, t), _measure(k, c)))
    for name, (table, by, kind, column, rows) in GROUP_CHARTS.items():
        on_warehouse(name, lambda w, t=table, b=by, k=kind, c=column, n=rows: dashboards.top_groups(
            _chart_table(w, t), b, _measure(k, c), n))
    for name, (table, day, values) in TIME_CHARTS.items():
        on_warehouse(name, lambda w, t=table, d=day, v=values: dashboards.sums_over_time(_chart_table(w, t), d, v))


_register_charts()
on_warehouse("chart_orders_by_day", lambda w: w.table("fct_orders").groupBy(F.col("order_date").alias("time")).agg(
    F.count(F.lit(1)).alias("orders")))
on_warehouse("chart_retention_by_day", lambda w: w.table(COHORTS).groupBy(F.col("activity_date").alias("time")).agg(
    F.round(F.avg("retention_rate"), 9).alias("retention_rate")))
on_warehouse("kpi_top_products", lambda w: dashboards.top_products(
    w.plain("bridge_order_product"), w.plain("dim_products")).withColumn("product_hub_key", digest(F.col("product_hub_key"))))
on_warehouse("kpi_items_per_order", lambda w: dashboards.items_per_order(w.table("fct_orders")))
on_warehouse("kpi_rolling_retention", lambda w: dashboards.rolling_retention(w.table("mart_user_rfm")))
on_warehouse("kpi_purchase_frequency", lambda w: dashboards.purchase_frequency(w.table("mart_user_rfm")))
on_warehouse("agg_daily_sales_calendar", lambda w: serving.agg_daily_sales(
    w.table("fct_daily_sales"), calendar_days=True))

# --- extraction, messages, contracts ------------------------------------------------------

ORDERS, ITEMS = SOURCES["orders"], SOURCES["order_items"]
on_warehouse("extract_after_timestamp", lambda w: extract_page(
    w.raw("oltp_orders"), ORDERS, Cursor("1998-06-01 00:00:00"), 5000))
on_warehouse("extract_after_keyset", lambda w: extract_page(
    w.raw("oltp_orders"), ORDERS, Cursor("1998-06-01 00:00:00", 700), 5000))
on_warehouse("extract_full", lambda w: extract_page(w.raw("oltp_order_items"), ITEMS, Cursor(), 5000))
on_warehouse("parsed_orders", lambda w: order_rows(w.raw("order_messages")))
on_warehouse("parsed_payments", lambda w: payment_rows(w.raw("payment_messages")))
on_warehouse("parsed_extension_events", lambda w: extension_rows(w.raw("order_messages"), "orders"))
on_warehouse("parsed_file_payments", lambda w: file_payment_rows(
    w.raw("payment_messages"), F.lit("payments/batch.jsonl")))
on_warehouse("message_projection", lambda w: message_projection(w.raw("change_messages")))
on_warehouse("contract_orders", lambda w: with_violations(order_rows(w.raw("order_messages")), ORDER_EVENT).select(
    "kafka_offset", F.array_join("violations", ",").alias("violations")))
on_warehouse("contract_payments", lambda w: split(payment_rows(w.raw("payment_messages")), PAYMENT_EVENT)[1].select(
    "kafka_offset", F.array_join("violations", ",").alias("violations")))
on_warehouse("contract_clean_orders", lambda w: split(w.frame("clean_orders"), CLEAN_ORDER)[0])
on_warehouse("ingest_slice", lambda w: ingest_slice(w.raw("oltp_orders"), datetime(1999, 1, 1), datetime(2000, 1, 1)))

LANDED_ROW = ("event_id string, event_type string, payment_id bigint, order_id bigint, transaction_id string, "
              "amount decimal(14,2), currency string, payment_method string, status string, decline_reason string, "
              "timestamp bigint")


@_warehouse_query("landing_payments")
def _landing_payments(w: Warehouse) -> DataFrame:
    """Payment events written as JSON lines, discovered, read with bad lines set apart, stamped with an id."""
    folder = _work_dir(w, "landing-payments")
    messages = w.raw("payment_messages").select(
        F.when(F.col("value").contains("DECLINED"), F.concat(F.lit("broken "), "value")).otherwise(F.col("value")))
    messages.write.text(f"{folder}/payments.jsonl")
    manifest = w.spark.createDataFrame([], files.MANIFEST_SCHEMA)
    found = files.discover(files.list_files(w.spark, folder), manifest, max_files=None)
    paths = [r[0] for r in found.collect()]
    lines = files.with_row_identity(files.read_jsonl(w.spark, paths, LANDED_ROW))
    good, _ = files.split_bad_lines(lines)
    return good.select("event_id", "payment_id", "order_id", "amount", "currency", "status",
                       F.timestamp_millis("timestamp").cast("timestamp_ntz").alias("event_ts"))


def _landed(w: Warehouse) -> tuple[BatchLog, BatchLog]:
    """Manifest and quarantine after two runs over three folders: JSON lines with broken ones, CSV, Parquet and an unknown format."""
    base = _work_dir(w, "landing")
    manifest, quarantine = new_logs(w.spark, base)
    prefixes = [Prefix(f"{base}/in/payments", LANDED_ROW, "jsonl"), Prefix(f"{base}/in/products", ""), Prefix(f"{base}/in/orders", "")]
    w.raw("payment_messages").select(F.when(F.col("value").contains("DECLINED"), F.concat(F.lit("broken "), "value")).otherwise(
        F.col("value"))).write.text(prefixes[0].folder)
    w.raw("oltp_products").select("product_id", "product_name").write.option("header", True).csv(prefixes[1].folder)
    w.raw("oltp_products").limit(1).select(F.col("product_name")).write.mode("append").text(prefixes[1].folder)
    w.raw("oltp_orders").select("order_id", "status").write.parquet(prefixes[2].folder)

    def store(prefix: Prefix, rows: DataFrame, run: int) -> None:
        rows.write.mode("overwrite").parquet(f"{base}/rows/{prefix.folder.rsplit('/', 1)[-1]}/run={run}")

    for _ in range(2):
        load_all(w.spark, prefixes, manifest, quarantine, store, CLOCK.now)
    return manifest, quarantine


@_warehouse_query("landing_manifest")
def _landing_manifest(w: Warehouse) -> DataFrame:
    """Rows per folder and status."""
    folder = F.regexp_extract("file_path", "/in/([a-z]+)/", 1)
    return newest_manifest(_landed(w)[0]).groupBy(folder.alias("prefix"), "status").agg(
        F.coalesce(F.sum("rows_loaded"), F.lit(0)).alias("rows_loaded"), F.max("error").alias("error"))


@_warehouse_query("landing_quarantine")
def _landing_quarantine(w: Warehouse) -> DataFrame:
    return _landed(w)[1].read().select("line")


@_warehouse_query("landing_catalog")
def _landing_catalog(w: Warehouse) -> DataFrame:
    """Catalog rows through a CSV file: header, every column text."""
    folder = _work_dir(w, "landing-catalog")
    rows = w.raw("oltp_products").select("product_id", "seller_id", "product_name", "category", "price", "is_active")
    rows.write.option("header", True).csv(folder)
    return files.read_csv(w.spark, folder).drop(files.SOURCE)


# --- change streams -----------------------------------------------------------------------

USER_ROW = "user_id bigint, state string, value decimal(12,2)"
on_warehouse("changes_applied", lambda w: live_rows(
    change_state(w.raw("change_messages"), USER_ROW, ["user_id"])))


def _delivered(w: Warehouse) -> str:
    """The events as four deliveries in a folder: three that mix early and late rows, then the first one again."""
    events, folder = sample(w.spark, w.directory, "events"), _work_dir(w, "inbox")
    part = F.pmod(F.xxhash64("event_id"), F.lit(3))
    for number in (0, 1, 2, 0):
        events.filter(part == number).coalesce(1).write.mode("append").parquet(folder)
    return folder


def _events_stream(w: Warehouse) -> DataFrame:
    """One micro-batch per delivery."""
    return file_stream(w.spark, _delivered(w), sample(w.spark, w.directory, "events").schema, 1)


@_warehouse_query("stream_changes_applied")
def _stream_changes(w: Warehouse) -> DataFrame:
    """The change log as a stream in several batches, reduced to the newest state per key."""
    base = _work_dir(w, "changes")
    log = BatchLog(w.spark, f"{base}/log", f"{USER_ROW}, {CHANGE_STATE}")
    collect_changes(feed_over(_events_stream(w), "change_messages", "events"), log, USER_ROW, ["user_id"], f"{base}/checkpoint")
    return live_rows(newest_state(log.read(), ["user_id"]))


@_warehouse_query("stream_event_log")
def _stream_log(w: Warehouse) -> DataFrame:
    """Idempotent log ingestion: positions delivered twice count once."""
    base = _work_dir(w, "log")
    log = BatchLog(w.spark, f"{base}/log", "topic string, partition_id int, kafka_offset bigint, event_type string, payload string")
    collect_rows(feed_over(_events_stream(w), "kafka_extension_events", "events"), log, f"{base}/checkpoint")
    return first_deliveries(log, ["topic", "partition_id", "kafka_offset"])


@_warehouse_query("stream_satellite")
def _stream_satellite(w: Warehouse) -> DataFrame:
    """Satellite versions from a stream of several batches with late and repeated rows."""
    base = _work_dir(w, "satellite")
    rows = feed_over(_events_stream(w), "user_state_log", "events").drop("batch")
    log = BatchLog(w.spark, f"{base}/log", rows.schema)
    collect_rows(rows, log, f"{base}/checkpoint")
    return satellite_of(log, STATE)


@_warehouse_query("ingested_messages")
def _ingested_messages(w: Warehouse) -> DataFrame:
    """Order messages loaded in three runs that go on after the stored offsets; the rows and the last marks."""
    base = _work_dir(w, "ingest")
    messages = w.raw("order_messages")
    target = BatchLog(w.spark, f"{base}/rows", order_rows(messages.limit(0)).schema)
    marks = BatchLog(w.spark, f"{base}/marks", watermarks.SCHEMA)
    half = (messages.agg(F.max("offset")).first()[0] or 0) // 2
    # What a log has grown to at each run; the last run finds nothing new.
    for grown in (messages.filter(F.col("offset") <= half), messages, messages):
        load_messages(grown, order_rows, target, marks, "orders", CLOCK.now)
    return target.read().groupBy("topic", "partition_id").agg(F.count(F.lit(1)).alias("n"), F.max("kafka_offset").alias("last_offset"))


# --- quality, metadata --------------------------------------------------------------------

CHECKS = (
    CheckSpec("stg_customers_pk_unique", "clean_customers", "unique", "critical", ("customer_id",)),
    CheckSpec("stg_orders_not_null", "clean_orders", "not_null", "critical",
              ("order_id", "customer_id", "order_ts", "status")),
    CheckSpec("stg_orders_total_positive", "clean_orders", "range", "error", ("total_amount",), min_value=0),
    CheckSpec("vault_hub_customers_unique_bk", "hub_customers", "unique", "critical", ("business_key",)),
    CheckSpec("vault_link_referential_integrity", "link_customer_order", "referential", "critical",
              ("customer_hub_key",), parent_table="hub_customers", parent_column="hub_key"),
    CheckSpec("vault_sat_customer_one_current", "sat_customer_details", "scd2_one_current", "critical", ("hub_key",)),
    CheckSpec("vault_sat_order_one_current", "sat_order_status", "scd2_one_current", "critical", ("hub_key",),
              current="exactly_one"),
    CheckSpec("marts_fct_orders_referential", "fct_orders", "referential", "error", ("customer_hub_key",),
              parent_table="dim_customers", parent_column="customer_hub_key"),
    CheckSpec("marts_fct_orders_amount_positive", "fct_orders", "range", "error", ("total_amount",), min_value=0),
    CheckSpec("raw_items_unique", "raw_items", "unique", "warning", ("order_item_id",)),
    CheckSpec("raw_payments_event_id", "raw_payments", "not_null", "warning", ("event_id",)),
    CheckSpec("raw_payments_amount_range", "raw_payments", "range", "warning", ("amount",), min_value=5000,
              max_value=400000),
    CheckSpec("raw_payments_amount_unbounded", "raw_payments", "range", "warning", ("amount",)),
    CheckSpec("payment_orders_known", "raw_payments", "referential", "warning", ("event_id",),
              parent_table="parsed_payments", parent_column="event_id"),
    CheckSpec("payment_orders_known_if_set", "raw_payments", "referential", "warning", ("event_id",),
              parent_table="parsed_payments", parent_column="event_id", null_child="ignore"),
    CheckSpec("customer_segment_accepted", "dim_customers", "accepted_values", "error", ("customer_segment",),
              values=("platinum", "gold", "silver", "bronze"), where="customer_segment is not null"),
    CheckSpec("payment_state_accepted", "fct_orders", "accepted_values", "error", ("payment_state",),
              values=("fully_paid", "partially_paid")),
    CheckSpec("price_not_negative", "dim_products", "non_negative", "error", ("price",)),
    CheckSpec("amount_predicate", "fct_orders", "predicate", "warning", predicate="total_amount > 300000"),
    CheckSpec("orders_present", "fct_orders", "min_row_count", "error", min_rows=1000000000),
    CheckSpec("retention_grain_unique", COHORTS, "unique", "error",
              ("cohort_month", "activity_date", "days_since_first_order")),
    CheckSpec("retention_two_column_grain", COHORTS, "unique", "warning", ("cohort_month", "activity_date")),
)


_CHECKED_RAW = {
    "clean_customers": lambda w: w.frame("clean_customers"), "clean_orders": lambda w: w.frame("clean_orders"),
    "raw_items": lambda w: w.raw("oltp_order_items"), "raw_payments": lambda w: w.raw("kafka_payments"),
    "parsed_payments": lambda w: w.raw("file_payments").select(
        F.concat(F.lit("pay-"), F.col("payment_id").cast("string")).alias("event_id"))}


def _checked_tables(w: Warehouse, specs: Iterable[CheckSpec]) -> dict[str, DataFrame]:
    """The tables that ``specs`` read; no other table is built for them."""
    names = dict.fromkeys(n for s in specs for n in (s.table, s.parent_table) if n)
    # Checks compare keys and count; the texts of the keys do for both.
    return {n: _CHECKED_RAW[n](w) if n in _CHECKED_RAW else w.plain(n) for n in names}


def _failing(w: Warehouse, check: str) -> DataFrame:
    spec = next(c for c in CHECKS if c.name == check)
    return failing_rows(spec, _checked_tables(w, [spec]))


on_warehouse("dq_results", lambda w: evaluate(CHECKS, _checked_tables(w, CHECKS)))
on_warehouse("dq_failing_duplicates", lambda w: duplicates(w.raw("oltp_order_items"), ["order_item_id"]))
on_warehouse("dq_failing_orphans", lambda w: _failing(w, "payment_orders_known").select(
    "topic", "partition_id", "kafka_offset", "event_id"))
on_warehouse("dq_sat_gaps", lambda w: invariants.gaps(_second_load(w).unionByName(_first_load(w))))
on_warehouse("dq_sat_overlaps", lambda w: invariants.overlaps(
    _second_load(w).unionByName(_first_load(w))).select("hub_key", "effective_from").distinct())
on_warehouse("dq_sat_one_current", lambda w: wrong_current(
    _second_load(w).unionByName(_first_load(w)), mode="exactly_one"))
on_warehouse("dq_pit_violations", lambda w: invariants.pit_violations(
    build_pit(_second_load(w).select("hub_key").distinct(), [("s", _first_load(w))], EVENTS_NOW.date(), 30),
    _second_load(w), "s"))
on_warehouse("dq_bridge_violations", lambda w: digested("bridge_customer_order", invariants.bridge_violations(
    w.plain("bridge_customer_order"),
    # A fault to find: links since June 2001 have lost their order.
    w.plain("link_customer_order").withColumn("order_hub_key", F.when(F.col("load_dts") < F.lit(datetime(2001, 6, 1)), F.col("order_hub_key"))),
    ["link_key", "customer_hub_key", "order_hub_key"])))
on_warehouse("dq_business_rules", lambda w: row_counts({
    "segments": invariants.segment_violations(w.table("dim_customers")),
    "prices": invariants.negative_prices(w.table("dim_products")),
    "payment_states": invariants.payment_state_violations(w.table("fct_orders")),
    "success_rates": invariants.rates_outside_unit(w.table("agg_payment_performance"))}))
on_warehouse("dq_freshness", lambda w: freshness({
    "oltp_orders": (w.raw("oltp_orders"), OLTP), "kafka_payments": (w.raw("kafka_payments"), KAFKA),
    "file_payments": (w.raw("file_payments"), Freshness("loaded_at")),
    "extension_events": (w.raw("kafka_extension_events"), EXTENSION)}, CLOCK.now))
on_warehouse("dq_layer_counts", lambda w: layer_counts({
    "customers": (w.raw("oltp_users"), w.table("stg_customers")), "orders": (w.raw("oltp_orders"), w.table("stg_orders")),
    "emptied": (w.raw("oltp_orders"), w.table("stg_orders").filter("total_amount < 0"))}))
on_warehouse("dq_layer_offenders", lambda w: offenders(QUERIES["dq_layer_counts"](w.spark, w.directory)))

on_warehouse("offsets_last", lambda w: last_offsets(w.raw("kafka_extension_events")))
on_warehouse("offsets_merged", lambda w: merged_offsets(
    last_offsets(w.raw("kafka_payments")).withColumn("last_offset", F.col("last_offset") - 10),
    last_offsets(w.raw("kafka_orders")).withColumn("topic", F.lit("payments"))))
on_warehouse("offsets_lag", lambda w: offset_lag(
    last_offsets(w.raw("kafka_extension_events")).select(
        "topic", "partition_id", (F.col("last_offset") + 1).alias("high_offset")),
    last_offsets(w.raw("kafka_extension_events")).withColumn("last_offset", F.col("last_offset") - 5 * F.col("partition_id"))))
on_warehouse("ingestion_lag", lambda w: ingestion_lag(
    w.raw("kafka_extension_events"), "ingested_at", EVENTS_NOW, "topic"))
on_warehouse("runs_recent", lambda w: runs.recent_runs(w.raw("pipeline_runs"), EVENTS_NOW))
on_warehouse("runs_summary", lambda w: runs.run_summary(w.raw("pipeline_runs"), EVENTS_NOW))
on_warehouse("runs_success_ratio", lambda w: runs.success_ratio(runs.run_summary(w.raw("pipeline_runs"), EVENTS_NOW)))
on_warehouse("runs_over_time", lambda w: runs.runs_over_time(w.raw("pipeline_runs"), EVENTS_NOW))
on_warehouse("runs_state_counts", lambda w: runs.state_counts(w.raw("pipeline_runs"), EVENTS_NOW))
on_warehouse("runs_longest", lambda w: runs.longest_runs(w.raw("pipeline_runs"), EVENTS_NOW))
on_warehouse("runs_latest_failures", lambda w: runs.latest_failures(w.raw("pipeline_runs"), EVENTS_NOW))
on_warehouse("runs_latest", lambda w: runs.latest_rows(
    runs.recent_runs(w.raw("pipeline_runs"), EVENTS_NOW), "started_at", "run_id"))
# The checks as a result log: every row with its time, those of the last week.
on_warehouse("dq_result_log", lambda w: runs.recent_results(execute_checks(
    CHECKS, _checked_tables(w, CHECKS), CLOCK.now), CLOCK.now).drop("checked_at"))
on_warehouse("runs_started", lambda w: runs.start(
    w.raw("pipeline_runs").filter("status <> 'running'"), w.raw("pipeline_runs").select("run_id", "dag_id", "task_id", "source", "layer", "payload"), EVENTS_NOW))
on_warehouse("runs_finished", lambda w: runs.finish(
    w.raw("pipeline_runs"), w.raw("pipeline_runs").filter("status = 'running'").select(
        "run_id", F.lit("success").alias("status"), F.col("started_at").alias("finished_at"),
        F.lit(5).cast("long").alias("rows_in"), F.lit(5).cast("long").alias("rows_out"),
        F.lit(0).cast("long").alias("rows_quarantined"), F.lit(None).cast("string").alias("error_message"),
        F.lit('{"done": true}').alias("payload"))))

# --- marketplace analytics, vectors, training ---------------------------------------------

on_warehouse("campaign_ratios", lambda w: marketplace.campaign_ratios(w.raw("campaign_performance")))
on_warehouse("keyword_rank_changes", lambda w: marketplace.rank_changes(w.raw("keyword_ranks")))
on_warehouse("web_vitals_p95_exact", lambda w: marketplace.web_vitals_p95_exact(w.raw("web_vitals")))
on_warehouse("web_vitals_p95", lambda w: marketplace.web_vitals_p95(w.raw("web_vitals")))
on_warehouse("orders_by_country", lambda w: marketplace.orders_by_country(w.frame("clean_order_events")))
on_warehouse("order_item_totals", lambda w: marketplace.item_totals(marketplace.order_events(
    w.table("stg_orders").select(F.col("order_bk").cast("long").alias("order_id"), "total_amount"),
    w.raw("order_items_nested"))))
on_warehouse("session_rates", lambda w: marketplace.session_rates(w.raw("organic_sessions")))
on_warehouse("worked_time", lambda w: marketplace.worked_time(w.raw("clock_events")))
on_warehouse("vector_normalised", lambda w: sample(w.spark, w.directory, "embeddings").select(
    "vec_id", F.posexplode(l2_normalise(F.col("embedding"))).alias("pos", "x")).select(
    "vec_id", "pos", F.round("x", 9).alias("x")))


@_warehouse_query("vector_top_k")
def _vector_top_k(w: Warehouse) -> DataFrame:
    """Five vectors nearest to the mean direction of every label."""
    corpus = sample(w.spark, w.directory, "embeddings")
    unit = corpus.select("vec_id", l2_normalise(F.col("embedding")).alias("embedding"))
    return top_k(unit, label_centroids(corpus), 5).withColumn("score", F.round("score", 6))


@_warehouse_query("vector_neighbours")
def _vector_neighbours(w: Warehouse) -> DataFrame:
    """Five nearest vectors, itself included, of each vector whose id is divisible by 20, among all."""
    unit = sample(w.spark, w.directory, "embeddings").select("vec_id", l2_normalise(F.col("embedding")).alias("embedding"))
    return top_k_many(unit, unit.filter("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id"), 5).withColumn("score", F.round("score", 6))


@_warehouse_query("order_value_model")
def _order_value_model(w: Warehouse) -> DataFrame:
    """Sizes and parameters of the trained model; its errors are kept out of the comparison."""
    _, metrics = train(w.table("stg_orders"), CLOCK.now, TrainingSpec(days=3650))
    return metrics
