"""The raw vault of the marketplace: which hubs, links and satellites exist."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keys import HubSpec, LinkSpec
from ..operators.scd2 import SatSpec

# Staging keeps one row per id of these, so hubs and links of them are its rows.
HUBS = {h.name: h for h in (
    HubSpec("hub_customers", "stg_customers", "customer_bk", single_row=True),
    HubSpec("hub_orders", "stg_orders", "order_bk", single_row=True),
    HubSpec("hub_products", "stg_products", "product_bk", single_row=True),
    HubSpec("hub_payments", "stg_payments", "payment_bk", single_row=True),
    HubSpec("hub_campaigns", "stg_marketing_campaigns", "campaign_bk", single_row=True),
    HubSpec("hub_seo_keywords", "stg_seo_keywords", "keyword_bk", single_row=True),
    HubSpec("hub_feature_flags", "stg_feature_flags", "flag_bk"),
    HubSpec("hub_employees", "stg_employees", "employee_bk"),
    HubSpec("hub_gl_entries", "stg_general_ledger", "gl_entry_bk"),
    HubSpec("hub_extension_events", "stg_extension_events", "event_bk"),
)}

LINKS = {k.name: k for k in (
    LinkSpec("link_customer_order", "stg_orders", (("customer", "customer_bk"), ("order", "order_bk")), single_row=True),
    LinkSpec("link_order_payment", "stg_payments", (("order", "order_bk"), ("payment", "payment_bk")), single_row=True),
    LinkSpec("link_order_product", "stg_order_items", (("order", "order_bk"), ("product", "product_bk"))),
)}

# Business keys made from a numeric id are unique after staging; the others can collide
# (letter case, blanks) and keep the full version logic.
SATELLITES = {s.name: s for s in (
    SatSpec("sat_customer_details", "stg_customers",
            ("customer_hash", "masked_email", "masked_name", "registered_at"), single_version=True),
    SatSpec("sat_order_status", "stg_orders", ("status", "currency", "total_amount", "order_ts"),
            single_version=True),
    SatSpec("sat_product_attributes", "stg_products",
            ("sku", "product_name", "category", "price", "is_active", "seller_bk"), single_version=True),
    SatSpec("sat_payment_details", "stg_payments",
            ("amount", "currency", "payment_method", "status", "decline_reason", "transaction_id"),
            single_version=True),
    SatSpec("sat_campaign_details", "stg_marketing_campaigns",
            ("campaign_name", "campaign_type", "channel", "budget", "currency", "start_date", "end_date", "status",
             "target_audience", "created_by"), single_version=True),
    SatSpec("sat_seo_keyword_details", "stg_seo_keywords",
            ("keyword", "keyword_category", "target_url", "search_volume", "competition_score", "cpc_estimate",
             "currency", "current_rank", "target_rank", "is_tracked"), single_version=True),
    SatSpec("sat_feature_flag_details", "stg_feature_flags",
            ("flag_name", "description", "is_enabled", "rollout_percentage", "targeting_rules")),
    SatSpec("sat_employee_details", "stg_employees",
            ("first_name", "last_name", "email", "department", "job_title", "level", "manager_id", "hire_date",
             "termination_date", "employment_status", "location", "remote_status", "salary", "currency")),
    SatSpec("sat_gl_entry_details", "stg_general_ledger",
            ("entry_date", "account_code", "account_name", "account_type", "debit_amount", "credit_amount",
             "currency", "transaction_type", "reference_id", "reference_type", "description", "posted_by")),
    SatSpec("sat_extension_event_payload", "stg_extension_events",
            ("domain_code", "event_type", "payload", "topic", "partition_id", "kafka_offset")),
)}


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table; an empty table counts 0."""
    counted = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
               for n, df in tables.items()]
    return reduce(DataFrame.unionByName, counted)
