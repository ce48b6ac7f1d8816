"""Business vault: bridges and satellites with derived attributes."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash_columns, hash_parts
from ..functions.measures import HIGH_VALUE_FROM, is_success, payment_state, segment
from ..functions.text import email_domain, email_is_valid
from ..operators.bridge import bridge_key, build_bridge
from ..operators.keys import Key
from ..operators.scd2 import HEAD, SatSpec
from ..session import written

CUSTOMER_RULES = SatSpec(
    "sat_customer_business", "sat_customer_details",
    ("email_domain", "is_email_valid", "customer_segment", "spend_90d", "order_count_90d"), single_version=True)
ORDER_RULES = SatSpec(
    "sat_order_enriched", "sat_order_status",
    ("status", "currency", "total_amount", "order_ts", "is_high_value", "total_items", "total_quantity",
     "has_successful_payment", "paid_amount", "payment_state"), single_version=True)


def bridge_customer_order(link: DataFrame, customers: DataFrame, orders: DataFrame) -> DataFrame:
    return build_bridge(link, {"customer": customers, "order": orders})


def bridge_order_product(link: DataFrame, orders: DataFrame, products: DataFrame, items: DataFrame) -> DataFrame:
    """Link rows with quantity and amount per order and product, and a key of their own."""
    return order_product_rows(link, orders, products, items).select(bridge_key("link_key", "order_hub_key", "product_hub_key"), "*")


def order_product_rows(link: DataFrame, orders: DataFrame, products: DataFrame, items: DataFrame, key: Key = hash_parts) -> DataFrame:
    """The bridge without its own key; ``key`` is what the keys of ``link`` were made with.

    Lines are dealt out once, by order, which no hot product can dominate; they are summed
    there and meet the hub of orders and the link there. Products that the hub does not know
    are found among the distinct ones and taken out, so lines are never dealt out by product
    unless very many products are unknown.
    """
    dealt = items.dropna(subset=["order_bk", "product_bk"]).select(
        key([F.col("order_bk")]).alias("order_hub_key"), "order_bk", "product_bk", "quantity", "line_amount", "load_dts",
        "record_source").repartition("order_hub_key")
    lines = dealt.groupBy("order_hub_key", "order_bk", "product_bk").agg(
        *line_sums(), F.max("load_dts").alias("load_dts"), F.min("record_source").alias("record_source"))
    keyed = _known_lines(lines, orders, products, items).withColumn("product_hub_key", key([F.col("product_bk")])).drop("order_bk", "product_bk")
    ends = link.select("link_key", "order_hub_key", "product_hub_key")
    return keyed.join(ends, ["order_hub_key", "product_hub_key"]).select(
        "link_key", "order_hub_key", "product_hub_key",
        "total_quantity", "total_line_amount", "load_dts", "record_source")


def line_sums() -> list[Column]:
    return [F.sum("quantity").cast("long").alias("total_quantity"), F.sum("line_amount").cast("decimal(24,2)").alias("total_line_amount")]


def link_sums() -> list[Column]:
    """What a link from orders to products has to carry of the lines that it is made of."""
    return [*line_sums(), F.max("load_dts").alias("last_load_dts")]


def _unknown_products(products: DataFrame, sold: DataFrame) -> DataFrame:
    return written(sold.select("product_bk").distinct().join(
        products.select(F.col("business_key").alias("product_bk")), "product_bk", "left_anti"), "unknown-products")


def _known_lines(lines: DataFrame, orders: DataFrame, products: DataFrame, sold: DataFrame) -> DataFrame:
    unknown = _unknown_products(products, sold)
    return lines.join(
        orders.select(F.col("hub_key").alias("order_hub_key"), F.col("business_key").alias("order_bk")),
        ["order_hub_key", "order_bk"], "left_semi").join(unknown, "product_bk", "left_anti")


def linked_product_rows(link: DataFrame, orders: DataFrame, products: DataFrame, sold: DataFrame, key: Key = hash_parts) -> DataFrame:
    """:func:`order_product_rows` where ``link`` is made of the lines themselves and carries :func:`link_sums`, by ids that are
    equal if and only if their keys are: lines and link are one aggregation, so they need not meet again, and meet the hubs by key.

    ``sold`` has at least the products of the lines, in any number of rows; ``key`` is what the keys of ``link`` were made with.
    """
    unknown = _unknown_products(products, sold).dropna().select(key([F.col("product_bk")]).alias("product_hub_key"))
    known = link.join(orders.select(F.col("hub_key").alias("order_hub_key")), "order_hub_key", "left_semi").join(
        unknown, "product_hub_key", "left_anti")
    return known.select(
        "link_key", "order_hub_key", "product_hub_key",
        "total_quantity", "total_line_amount", F.col("last_load_dts").alias("load_dts"), "record_source")


def with_change_hash(rows: DataFrame, spec: SatSpec) -> DataFrame:
    """Adds hashdiff; an order's own time is no change of it."""
    hashed = [c for c in spec.columns if c != "order_ts"]
    return rows.withColumn("hashdiff", hash_columns(rows, hashed)).select(*HEAD, *spec.columns)


def _versions(rows: DataFrame, spec: SatSpec) -> DataFrame:
    end_type = rows.schema["effective_from"].dataType
    return with_change_hash(rows.withColumns({"effective_to": F.lit(None).cast(end_type), "is_current": F.lit(True)}), spec)


def unknown_keys(rows: DataFrame, column: str, hub: DataFrame) -> DataFrame:
    """Keys in ``column`` that the hub does not have, once each."""
    return rows.select(column).dropna().distinct().join(hub.select(F.col("hub_key").alias(column)), column, "left_anti")


def without_unknown(rows: DataFrame, column: str, unknown: DataFrame) -> DataFrame:
    """NULL in place of unknown keys. Those are few as a rule, so rows stay where they are."""
    marked = rows.join(unknown.select(column, F.lit(True).alias("_unknown")), column, "left")
    return marked.withColumn(column, F.when(F.col("_unknown").isNull(), F.col(column))).drop("_unknown")


def customer_rules(details: DataFrame, bridge: DataFrame, order_status: DataFrame, as_of: datetime, *,
                   as_of_versions: bool = False) -> DataFrame:
    """Segment and 90-day spend of every current customer.

    Versions start where the raw version starts, so a change of spend alone opens no new
    version. ``as_of_versions=True`` starts them at the clock instead.
    """
    current = order_status.filter("is_current").select(F.col("hub_key").alias("order_hub_key"), "total_amount", "order_ts")
    return ruled_customers(details, bridge.join(current, "order_hub_key"), as_of, as_of_versions=as_of_versions)


def ruled_customers(details: DataFrame, orders: DataFrame, as_of: datetime, *, as_of_versions: bool = False) -> DataFrame:
    """:func:`customer_rules` from current orders with the key of their customer."""
    recent = orders.filter(F.col("customer_hub_key").isNotNull() & (F.col("order_ts") >= F.lit(as_of - timedelta(days=90))))
    spend = recent.groupBy(F.col("customer_hub_key").alias("hub_key")).agg(
        F.sum("total_amount").alias("spend"), F.countDistinct("order_hub_key").alias("orders"))
    rows = details.filter("is_current").join(spend, "hub_key", "left")
    total = F.coalesce("spend", F.lit(0)).cast("decimal(24,2)")
    start = F.lit(as_of).cast("timestamp_ntz") if as_of_versions else F.col("effective_from")
    ruled = rows.select(
        "hub_key", "load_dts", start.alias("effective_from"),
        F.coalesce("record_source", F.lit("bdv_customer_business")).alias("record_source"),
        email_domain(F.col("masked_email")).alias("email_domain"),
        email_is_valid(F.col("masked_email")).alias("is_email_valid"),
        segment(total).alias("customer_segment"), total.alias("spend_90d"),
        F.coalesce("orders", F.lit(0)).cast("long").alias("order_count_90d"))
    return _versions(ruled, CUSTOMER_RULES)


def payments_per_order(link: DataFrame, payments: DataFrame, success: Iterable[str] = ("success",)) -> DataFrame:
    current = payments.filter("is_current").select(F.col("hub_key").alias("payment_hub_key"), "status", "amount")
    return paid_per_order(link.join(current, "payment_hub_key"), success)


def paid_per_order(payments: DataFrame, success: Iterable[str] = ("success",)) -> DataFrame:
    """Whether and how much was paid, from current payments with the key of their order."""
    paid = is_success(F.col("status"), success)
    return payments.select(F.col("order_hub_key").alias("hub_key"), paid.alias("paid"), "amount").groupBy("hub_key").agg(
        F.bool_or("paid").alias("paid"),
        F.sum(F.when(F.col("paid"), F.col("amount")).otherwise(F.lit(0))).alias("paid_total"))


def order_rules(order_status: DataFrame, bridge: DataFrame, link: DataFrame, payments: DataFrame,
                success: Iterable[str] = ("success",), as_of: datetime | None = None) -> DataFrame:
    """Payment state, size and value flags of every current order.

    With ``as_of`` versions start at the clock, so a late payment opens a new version.
    """
    return enriched_orders(order_status, bridge, payments_per_order(link, payments, success), as_of)


def enriched_orders(order_status: DataFrame, bridge: DataFrame, paid: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """:func:`order_rules` over what has been paid per order."""
    rows = _with_sums(order_status.filter("is_current").drop("hashdiff"), bridge, paid)
    start = F.col("effective_from") if as_of is None else F.lit(as_of).cast("timestamp_ntz")
    ruled = rows.select(
        "hub_key", "load_dts", start.alias("effective_from"),
        F.coalesce("record_source", F.lit("bdv_order_enriched")).alias("record_source"),
        *[measure.alias(name) for name, measure in _order_measures().items()])
    return _versions(ruled, ORDER_RULES)


def _with_sums(orders: DataFrame, bridge: DataFrame, paid: DataFrame) -> DataFrame:
    """Orders beside the sums of their lines and payments."""
    lines = bridge.groupBy(F.col("order_hub_key").alias("hub_key")).agg(
        F.sum("total_quantity").alias("quantity"), F.count(F.lit(1)).alias("items"))
    return orders.join(lines, "hub_key", "left").join(paid, "hub_key", "left")


def _order_measures() -> dict[str, Column]:
    """The columns of :data:`ORDER_RULES` over :func:`_with_sums`."""
    return {
        **{c: F.col(c) for c in ("status", "currency", "total_amount", "order_ts")},
        "is_high_value": F.col("total_amount") >= HIGH_VALUE_FROM,
        "total_items": F.coalesce("items", F.lit(0)).cast("long"),
        "total_quantity": F.coalesce("quantity", F.lit(0)).cast("long"),
        "has_successful_payment": F.coalesce("paid", F.lit(False)),
        "paid_amount": F.coalesce("paid_total", F.lit(0)).cast("decimal(24,2)"),
        "payment_state": payment_state(F.col("paid"), F.col("paid_total"), F.col("total_amount"))}


def described_orders(orders: DataFrame, bridge: DataFrame, paid: DataFrame) -> DataFrame:
    """Hub, customer and enriched version of every order in one row; ``orders`` has hub, link and raw version side by side.

    Equal to the hub joined with its link and with :func:`enriched_orders`, but orders are dealt out once.
    """
    measures = [F.when(F.col("has_version"), measure).alias(name) for name, measure in _order_measures().items()]
    return _with_sums(orders, bridge, paid).select("hub_key", "business_key", "customer_hub_key", "load_dts", *measures)
