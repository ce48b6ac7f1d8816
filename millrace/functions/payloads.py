"""Event messages (JSON text in ``value``) to typed rows.

Messages come as ``topic, partition, offset, timestamp, value``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import leading

# A number above this bound is milliseconds, otherwise seconds.
MILLIS_FROM = 1e12
EVENT_TIME_FIELDS = ("event_timestamp", "event_ts", "timestamp", "ts")


# Every scalar the row builders read. One parse per message fills them all.
_FIELDS = ("event_id", "event_type", "order_id", "customer_id", "user_id", "total_amount", "amount", "currency",
           "country_code", "payment_id", "transaction_id", "payment_method", "status", "decline_reason",
           *EVENT_TIME_FIELDS)
_EVENT_SCHEMA = ", ".join(f"`{f}` string" for f in _FIELDS)


def field(name: str) -> Column:
    """Scalar field of the message as text, NULL when absent or empty."""
    return F.nullif(F.col(f"_event.{name}"), F.lit(""))


def first_field(*names: str) -> Column:
    return F.coalesce(*[field(n) for n in names])


def parse_moment(text: Column) -> Column:
    """ISO 8601 (``Z``, offset or naive UTC), seconds or milliseconds; anything else is NULL."""
    number = text.try_cast("double")
    millis = F.when(number > MILLIS_FROM, number).otherwise(number * 1000)
    parsed = F.when(number.isNotNull(), F.timestamp_millis(F.round(millis).cast("long"))).otherwise(
        F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), text.try_cast("timestamp")))
    return parsed.cast("timestamp_ntz")


def with_event(messages: DataFrame) -> DataFrame:
    """Adds the parsed scalars as ``_event``, the event time text, and ``payload``.

    The payload is the message itself, or an object that keeps text which is no JSON object.
    The parse sits in an explode of one element: a filter on a field is then evaluated on
    the parsed row, where a plain column would be parsed again inside every condition.
    """
    text = F.col("value").cast("string")
    event = F.from_json(text, f"{_EVENT_SCHEMA}, _bad string", {"columnNameOfCorruptRecord": "_bad"})
    parsed = messages.select("*", F.explode(F.array(event)).alias("_event"))
    usable = F.col("_event").isNotNull() & F.col("_event._bad").isNull() & F.ltrim(text).startswith("{")
    return parsed.withColumns({
        "payload": F.when(usable, text).otherwise(F.to_json(F.struct(text.alias("_raw")))),
        "_moment": first_field(*EVENT_TIME_FIELDS)})


def _position() -> list[Column]:
    return [F.col("topic"), F.col("partition").alias("partition_id"), F.col("offset").alias("kafka_offset")]


def _event_ts() -> Column:
    return parse_moment(F.col("_moment"))


def order_rows(messages: DataFrame) -> DataFrame:
    return with_event(messages).select(
        *_position(), field("event_id").alias("event_id"), field("event_type").alias("event_type"),
        field("order_id").try_cast("long").alias("order_id"),
        first_field("customer_id", "user_id").try_cast("long").alias("customer_id"),
        first_field("total_amount", "amount").try_cast("decimal(14,2)").alias("total_amount"),
        leading(field("currency"), 3).alias("currency"), leading(field("country_code"), 2).alias("country_code"),
        "payload", _event_ts().alias("event_ts"))


def payment_rows(messages: DataFrame) -> DataFrame:
    return with_event(messages).select(
        *_position(), field("event_id").alias("event_id"), field("event_type").alias("event_type"),
        field("payment_id").try_cast("long").alias("payment_id"), field("order_id").try_cast("long").alias("order_id"),
        field("transaction_id").alias("transaction_id"), field("amount").try_cast("decimal(14,2)").alias("amount"),
        leading(field("currency"), 3).alias("currency"), field("payment_method").alias("payment_method"),
        field("status").alias("status"), field("decline_reason").alias("decline_reason"),
        "payload", _event_ts().alias("event_ts"))


def extension_rows(messages: DataFrame, domain: str) -> DataFrame:
    """Any event; broker time stands in for a missing event time, no log position means no row."""
    placed = messages.dropna(subset=["partition", "offset"])
    return with_event(placed).select(
        F.coalesce("topic", F.lit("")).alias("topic"), F.col("partition").alias("partition_id"),
        F.col("offset").alias("kafka_offset"), F.lit(domain).alias("domain_code"),
        F.col("_event.event_id").alias("event_id"), field("event_type").alias("event_type"), "payload",
        F.coalesce(_event_ts(), F.col("timestamp").cast("timestamp_ntz")).alias("event_ts"))


def file_payment_rows(lines: DataFrame, path: Column) -> DataFrame:
    """Landed payment records (JSON text in ``value``) as staging rows.

    The id is path plus payment id, else event id, else a hash of the line: unlike a line
    number it does not depend on how the file was split.
    """
    identity = F.coalesce(field("payment_id"), field("event_id"), F.sha2(F.col("payload"), 256))
    return with_event(lines).select(
        F.concat_ws("::", path, identity).alias("event_uuid"), path.alias("source_file"),
        field("payment_id").try_cast("long").alias("payment_id"), field("order_id").try_cast("long").alias("order_id"),
        field("amount").try_cast("decimal(14,2)").alias("amount"), leading(field("currency"), 3).alias("currency"),
        field("status").alias("status"), _event_ts().alias("event_ts"))


def change_rows(messages: DataFrame, schema: str) -> DataFrame:
    """Change envelopes: operation, log time, and the row after (or, for a delete, before) the change."""
    text = F.col("value").cast("string")
    envelope = F.from_json(text, f"before struct<{schema}>, after struct<{schema}>, op string, ts_ms bigint")
    return messages.select(
        *_position(), envelope.alias("_e")).select(
        "topic", "partition_id", "kafka_offset", F.col("_e.op").alias("op"), F.col("_e.ts_ms").alias("ts_ms"),
        F.when(F.col("_e.op") == "d", F.col("_e.before")).otherwise(F.col("_e.after")).alias("row"))


def message_projection(stream: DataFrame) -> DataFrame:
    return stream.select(
        "topic", "partition", "offset", "timestamp", F.col("value").cast("string").alias("value_json"))


def merge_json(old: Column, new: Column) -> Column:
    """Fields of both objects, those of ``new`` on top; values keep their JSON type."""
    kind = "map<string,variant>"
    before = F.coalesce(F.from_json(old, kind), F.from_json(F.lit("{}"), kind))
    after = F.coalesce(F.from_json(new, kind), F.from_json(F.lit("{}"), kind))
    kept = F.map_filter(before, lambda k, _: ~F.array_contains(F.map_keys(after), k))
    return F.to_json(F.map_concat(kept, after))
