"""Staging tables: cleaned latest records with hash key and change hash."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import as_text, canonical_json, hash_columns, hash_parts, record_hash
from ..functions.privacy import identity_hash, mask_email, mask_name
from ..functions.text import blank_to_null, clean_lower, clean_upper
from ..operators.keys import Key
from ..operators.latest import latest_across_sources, latest_log_position, latest_snapshot
from ..operators.union import union_all

DEFAULT_SOURCE = "oltp_postgres"


def ingest_slice(df: DataFrame, lower: datetime, upper: datetime) -> DataFrame:
    """Rows taken in between two instants, both included."""
    return df.filter(F.col("ingested_at").between(F.lit(lower), F.lit(upper)))


def _source_name() -> Column:
    return F.coalesce(F.nullif(F.col("source_run_id"), F.lit("")), F.lit(DEFAULT_SOURCE)).alias("record_source")


def _text_id(name: str, alias: str) -> Column:
    return F.col(name).cast("string").alias(alias)


@dataclass(frozen=True)
class Hashed:
    """What key and change hash of a staging table are made of; JSON columns in ``canonical`` are hashed in canonical form."""

    business_key: str
    described_by: tuple[str, ...]
    canonical: tuple[str, ...] = ()


HASHED = {
    "stg_customers": Hashed("customer_bk", ("customer_hash", "masked_email", "masked_name", "registered_at")),
    "stg_orders": Hashed("order_bk", ("status", "currency", "total_amount", "order_ts")),
    "stg_products": Hashed("product_bk", ("sku", "product_name", "category", "price", "is_active", "seller_bk")),
    "stg_payments": Hashed("payment_bk", (
        "amount", "currency", "payment_method", "status", "decline_reason", "transaction_id")),
    "stg_marketing_campaigns": Hashed("campaign_bk", (
        "campaign_name", "campaign_type", "channel", "budget", "currency", "start_date", "end_date", "status",
        "target_audience", "created_by"), ("target_audience",)),
    "stg_seo_keywords": Hashed("keyword_bk", (
        "keyword", "keyword_category", "target_url", "search_volume", "competition_score", "cpc_estimate", "currency",
        "current_rank", "target_rank", "is_tracked")),
    "stg_feature_flags": Hashed("flag_bk", (
        "flag_name", "description", "is_enabled", "rollout_percentage", "targeting_rules"), ("targeting_rules",)),
    "stg_employees": Hashed("employee_bk", (
        "first_name", "last_name", "email", "department", "job_title", "level", "manager_id", "hire_date",
        "termination_date", "employment_status", "location", "remote_status", "salary", "currency")),
    "stg_general_ledger": Hashed("gl_entry_bk", (
        "entry_date", "account_code", "account_name", "account_type", "debit_amount", "credit_amount", "currency",
        "transaction_type", "reference_id", "reference_type", "description", "posted_by")),
    "stg_extension_events": Hashed("event_bk", ("domain_code", "event_type", "payload"), ("payload",)),
}


def with_hashes(df: DataFrame, table: str, key: Key = hash_parts) -> DataFrame:
    """Adds hub_key, as ``key`` makes it, and hashdiff of staging table ``table``."""
    spec = HASHED[table]
    hashed = df.withColumns({f"_c_{c}": canonical_json(F.col(c)) for c in spec.canonical})
    names = [f"_c_{c}" if c in spec.canonical else c for c in spec.described_by]
    return hashed.withColumns({
        "hub_key": key([as_text(F.col(spec.business_key), df.schema[spec.business_key].dataType)]),
        "hashdiff": hash_columns(hashed, names)}).drop(*[f"_c_{c}" for c in spec.canonical])


# --- cleaning job -----------------------------------------------------------------------

def clean_customers(users: DataFrame, salt: str) -> DataFrame:
    """Pseudonymised customers; neither address nor name leaves this function."""
    latest = latest_snapshot(users.dropna(subset=["user_id", "email"]), ["user_id"],
                             ties=["email", "full_name"])
    plain = latest.select(
        F.col("user_id").cast("long").alias("customer_id"), F.lower(F.trim("email")).alias("_email"),
        F.trim("full_name").alias("_name"), F.col("created_at").alias("registered_at"))
    masked = plain.select(
        "customer_id", "registered_at",
        identity_hash([F.col("customer_id"), F.col("_email"), F.col("_name")], salt).alias("customer_hash"),
        mask_email(F.col("_email")).alias("masked_email"), mask_name(F.col("_name")).alias("masked_name"))
    return masked.withColumn("source_record_hash", record_hash(
        masked, ["customer_id", "customer_hash", "masked_email", "masked_name", "registered_at"]))


def clean_orders(orders: DataFrame) -> DataFrame:
    latest = latest_snapshot(orders, ["order_id"], ties=["status", "total_amount"])
    usable = latest.dropna(subset=["order_id", "user_id", "order_ts"]).filter(F.col("total_amount") >= 0)
    typed = usable.select(
        F.col("order_id").cast("long"), F.col("user_id").cast("long").alias("customer_id"), "order_ts",
        F.lower(F.trim("status")).alias("status"), F.upper("currency_code").alias("currency_code"),
        F.col("total_amount").cast("decimal(14,2)"))
    return typed.withColumn("source_record_hash", record_hash(
        typed, ["order_id", "customer_id", "status", "currency_code", "total_amount"]))


def log_position_id() -> Column:
    return F.concat_ws(":", "topic", "partition_id", "kafka_offset")


def clean_order_events(log: DataFrame) -> DataFrame:
    return latest_log_position(log).dropna(subset=["event_id"]).select(
        log_position_id().alias("event_uuid"), "event_id", "event_type",
        F.col("order_id").cast("long"), F.col("customer_id").cast("long"),
        F.col("total_amount").cast("decimal(14,2)"), F.upper("currency").alias("currency"),
        F.upper("country_code").alias("country_code"), "event_ts")


def clean_payment_events(log: DataFrame) -> DataFrame:
    return latest_log_position(log).dropna(subset=["event_id"]).select(
        log_position_id().alias("event_uuid"), "event_id", "event_type",
        F.col("payment_id").cast("long"), F.col("order_id").cast("long"), "transaction_id",
        F.col("amount").cast("decimal(14,2)"), F.upper("currency").alias("currency"),
        F.lower("payment_method").alias("payment_method"), F.lower("status").alias("status"),
        "decline_reason", "event_ts")


# --- staging views ----------------------------------------------------------------------

def stg_customers(cleaned: DataFrame, loaded_at: Column) -> DataFrame:
    """``cleaned`` comes from :func:`clean_customers`, ``loaded_at`` is when a record took effect."""
    stamped = cleaned.withColumn("load_dts", loaded_at)
    latest = latest_snapshot(stamped.dropna(subset=["customer_id"]), ["customer_id"], stamp="load_dts",
                             ties=["source_record_hash"])
    shaped = latest.select(
        _text_id("customer_id", "customer_bk"), "customer_hash", "masked_email", "masked_name", "registered_at",
        "load_dts", F.col("load_dts").alias("effective_from"), F.lit("spark_preprocess").alias("record_source"))
    return with_hashes(shaped, "stg_customers")


def stg_orders(raw: DataFrame) -> DataFrame:
    latest = latest_snapshot(raw.dropna(subset=["order_id"]), ["order_id"], ties=["status", "total_amount"])
    return orders_shape(latest)


def orders_shape(raw: DataFrame) -> DataFrame:
    shaped = raw.select(
        _text_id("order_id", "order_bk"), _text_id("user_id", "customer_bk"), "order_ts",
        clean_lower(F.col("status")).alias("status"), clean_upper(F.col("currency_code")).alias("currency"),
        "total_amount", F.col("ingested_at").alias("load_dts"), F.col("ingested_at").alias("effective_from"),
        _source_name())
    return with_hashes(shaped, "stg_orders")


def stg_order_items(raw: DataFrame) -> DataFrame:
    latest = latest_snapshot(raw.dropna(subset=["order_item_id"]), ["order_item_id"],
                             ties=["product_id", "quantity", "unit_price"])
    return latest.select(
        _text_id("order_item_id", "order_item_bk"), _text_id("order_id", "order_bk"),
        _text_id("product_id", "product_bk"), "quantity", "unit_price",
        (F.col("quantity") * F.col("unit_price")).cast("decimal(18,2)").alias("line_amount"),
        F.col("ingested_at").alias("load_dts"), _source_name())


def sold_products(raw: DataFrame) -> DataFrame:
    """Products of all order items, also of item rows that later ones have replaced."""
    return raw.select(_text_id("product_id", "product_bk"))


def stg_products(raw: DataFrame) -> DataFrame:
    latest = latest_snapshot(raw.dropna(subset=["product_id"]), ["product_id"], ties=["price"])
    shaped = latest.select(
        _text_id("product_id", "product_bk"), _text_id("seller_id", "seller_bk"),
        clean_upper(F.col("sku")).alias("sku"), blank_to_null(F.col("product_name")).alias("product_name"),
        clean_lower(F.col("category")).alias("category"), "price",
        F.coalesce("is_active", F.lit(False)).alias("is_active"), F.col("created_at").alias("first_listed_at"),
        F.col("ingested_at").alias("load_dts"), F.col("ingested_at").alias("effective_from"), _source_name())
    return with_hashes(shaped, "stg_products")


def stg_payments(log: DataFrame, files: DataFrame) -> DataFrame:
    """Payments of the event log and of landed files; the latest event per payment wins."""
    def shape(df: DataFrame, loaded: str, origin: str) -> DataFrame:
        def optional(name: str) -> Column:
            return F.col(name) if name in df.columns else F.lit(None).cast("string")
        return df.dropna(subset=["payment_id"]).select(
            _text_id("payment_id", "payment_bk"), _text_id("order_id", "order_bk"),
            optional("transaction_id").alias("transaction_id"), "amount",
            clean_upper(F.col("currency")).alias("currency"),
            clean_lower(optional("payment_method")).alias("payment_method"),
            clean_lower(F.col("status")).alias("status"), optional("decline_reason").alias("decline_reason"),
            "event_ts", F.col(loaded).alias("load_dts"), F.lit(origin).alias("record_source"))

    both = union_all([shape(log, "ingested_at", "kafka_payments"), shape(files, "loaded_at", "minio_files")])
    latest = latest_across_sources(both, ["payment_bk"], "event_ts", "load_dts", ties=["record_source", "amount"])
    timed = latest.withColumn("effective_from", F.coalesce("event_ts", "load_dts"))
    return with_hashes(timed, "stg_payments")


def _record_time() -> list[Column]:
    moment = F.coalesce("updated_at", "created_at")
    return [moment.alias("record_effective_at"), F.col("ingested_at").alias("load_dts"),
            moment.alias("effective_from"), _source_name()]


def stg_marketing_campaigns(raw: DataFrame) -> DataFrame:
    latest = latest_snapshot(raw.dropna(subset=["campaign_id"]), ["campaign_id"])
    shaped = latest.select(
        _text_id("campaign_id", "campaign_bk"),
        *[blank_to_null(F.col(c)).alias(c) for c in ("campaign_name", "campaign_type", "channel")],
        "budget", "currency", "start_date", "end_date", "target_audience",
        blank_to_null(F.col("status")).alias("status"), "created_by", *_record_time())
    return with_hashes(shaped, "stg_marketing_campaigns")


def stg_seo_keywords(raw: DataFrame) -> DataFrame:
    latest = latest_snapshot(raw.dropna(subset=["keyword_id"]), ["keyword_id"])
    plain = ["target_url", "search_volume", "competition_score", "cpc_estimate", "currency", "current_rank",
             "target_rank"]
    shaped = latest.select(
        _text_id("keyword_id", "keyword_bk"), clean_lower(F.col("keyword")).alias("keyword"),
        blank_to_null(F.col("keyword_category")).alias("keyword_category"), *plain,
        F.coalesce("is_tracked", F.lit(True)).alias("is_tracked"), *_record_time())
    return with_hashes(shaped, "stg_seo_keywords")


def stg_feature_flags(raw: DataFrame) -> DataFrame:
    latest = latest_snapshot(raw.dropna(subset=["flag_id"]), ["flag_id"]).dropna(subset=["flag_key"])
    shaped = latest.select(
        clean_lower(F.col("flag_key")).alias("flag_bk"), blank_to_null(F.col("flag_name")).alias("flag_name"),
        "description", F.coalesce("is_enabled", F.lit(False)).alias("is_enabled"), "rollout_percentage",
        "targeting_rules", *_record_time())
    return with_hashes(shaped, "stg_feature_flags")


def stg_employees(raw: DataFrame) -> DataFrame:
    latest = latest_snapshot(raw.dropna(subset=["employee_id"]), ["employee_id"])
    shaped = latest.select(
        clean_upper(F.col("employee_number")).alias("employee_bk"),
        *[blank_to_null(F.col(c)).alias(c) for c in ("first_name", "last_name")],
        clean_lower(F.col("email")).alias("email"),
        *[blank_to_null(F.col(c)).alias(c) for c in ("department", "job_title")],
        "level", "manager_id", "hire_date", "termination_date",
        blank_to_null(F.col("employment_status")).alias("employment_status"),
        "location", "remote_status", "salary", "currency", *_record_time())
    return with_hashes(shaped, "stg_employees")


def stg_general_ledger(raw: DataFrame) -> DataFrame:
    latest = latest_snapshot(raw.dropna(subset=["entry_id"]), ["entry_id"])
    shaped = latest.select(
        clean_upper(F.col("entry_number")).alias("gl_entry_bk"), "entry_date",
        *[blank_to_null(F.col(c)).alias(c) for c in ("account_code", "account_name", "account_type")],
        *[F.coalesce(F.col(c), F.lit(0)).cast("decimal(15,2)").alias(c) for c in ("debit_amount", "credit_amount")],
        "currency", blank_to_null(F.col("transaction_type")).alias("transaction_type"), "reference_id",
        blank_to_null(F.col("reference_type")).alias("reference_type"), "description", "posted_by",
        F.col("created_at").alias("record_effective_at"), F.col("ingested_at").alias("load_dts"),
        F.col("created_at").alias("effective_from"), _source_name())
    return with_hashes(shaped, "stg_general_ledger")


def stg_extension_events(log: DataFrame) -> DataFrame:
    latest = latest_log_position(log)
    moment = F.coalesce("event_ts", "ingested_at")
    position = F.concat("topic", F.lit(":"), F.col("partition_id").cast("string"), F.lit(":"),
                        F.col("kafka_offset").cast("string"))
    shaped = latest.select(
        F.coalesce(blank_to_null(F.col("event_id")), position).alias("event_bk"),
        "topic", "partition_id", "kafka_offset", "domain_code", "event_type", "payload",
        moment.alias("record_effective_at"), F.col("ingested_at").alias("load_dts"),
        moment.alias("effective_from"), F.lit("kafka.extension_events").alias("record_source"))
    return with_hashes(shaped, "stg_extension_events")


BUILDERS: dict[str, Callable[..., DataFrame]] = {
    f.__name__: f for f in (
        stg_orders, stg_order_items, stg_products, stg_marketing_campaigns, stg_seo_keywords, stg_feature_flags,
        stg_employees, stg_general_ledger)}
