"""Incremental extraction from operational tables with a stored cursor."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..meta.watermarks import FALLBACK
from ..session import written


@dataclass(frozen=True)
class SourceSpec:
    table: str
    key: str
    columns: tuple[str, ...]
    cursor: str | None = "created_at"

    @property
    def target(self) -> str:
        return f"raw.oltp_{self.table}"


_STAMPS = ("created_at", "updated_at")

# Tables, columns and cursor columns that are extracted.
SOURCES = {s.table: s for s in (
    SourceSpec("users", "user_id", ("user_id", "email", "full_name", "created_at")),
    SourceSpec("sellers", "seller_id", ("seller_id", "seller_name", "rating", "created_at")),
    SourceSpec("products", "product_id", ("product_id", "seller_id", "sku", "product_name", "category", "price",
                                          "is_active", "created_at")),
    SourceSpec("orders", "order_id", ("order_id", "user_id", "order_ts", "status", "currency_code", "total_amount"),
               "order_ts"),
    SourceSpec("order_items", "order_item_id", ("order_item_id", "order_id", "product_id", "quantity", "unit_price"),
               None),
    SourceSpec("marketing_campaigns", "campaign_id", (
        "campaign_id", "campaign_name", "campaign_type", "channel", "budget", "currency", "start_date", "end_date",
        "target_audience", "status", "created_by", *_STAMPS), "updated_at"),
    SourceSpec("seo_keywords", "keyword_id", (
        "keyword_id", "keyword", "keyword_category", "target_url", "search_volume", "competition_score",
        "cpc_estimate", "currency", "current_rank", "target_rank", "is_tracked", *_STAMPS), "updated_at"),
    SourceSpec("feature_flags", "flag_id", (
        "flag_id", "flag_key", "flag_name", "description", "is_enabled", "rollout_percentage", "targeting_rules",
        *_STAMPS), "updated_at"),
    SourceSpec("employees", "employee_id", (
        "employee_id", "employee_number", "first_name", "last_name", "email", "department", "job_title", "level",
        "manager_id", "hire_date", "termination_date", "employment_status", "location", "remote_status", "salary",
        "currency", *_STAMPS), "updated_at"),
    SourceSpec("general_ledger", "entry_id", (
        "entry_id", "entry_date", "entry_number", "account_code", "account_name", "account_type", "debit_amount",
        "credit_amount", "currency", "transaction_type", "reference_id", "reference_type", "description",
        "posted_by", "created_at")),
)}


@dataclass(frozen=True)
class Cursor:
    """Position after the last extracted row. Without ``key`` it is a plain timestamp."""

    ts: str = FALLBACK
    key: str | int | None = None

    @classmethod
    def parse(cls, text: str | None) -> Cursor:
        if not text:
            return cls()
        try:
            value = json.loads(text)
        except ValueError:
            return cls(text)
        return cls(value["ts"], value.get("pk")) if isinstance(value, dict) else cls(text)

    def text(self) -> str:
        return self.ts if self.key is None else json.dumps({"ts": self.ts, "pk": self.key})


def extract_page(df: DataFrame, spec: SourceSpec, cursor: Cursor, size: int) -> DataFrame:
    """Next ``size`` rows after the cursor; a table without a cursor column is read whole."""
    if spec.cursor is None:
        return df.select(*spec.columns)
    ts, key = F.col(spec.cursor), F.col(spec.key)
    since = F.lit(cursor.ts).cast(df.schema[spec.cursor].dataType)
    after = ts > since
    if cursor.key is not None:
        after = after | ((ts == since) & (key > F.lit(cursor.key)))
    return df.filter(after).orderBy(ts.asc(), key.asc()).limit(size).select(*spec.columns)


def next_cursor(page: DataFrame, spec: SourceSpec, cursor: Cursor) -> Cursor:
    """Position of the last row of a page; unchanged for an empty page or a full extract."""
    if spec.cursor is None:
        return cursor
    stamp = F.date_format(F.col(spec.cursor), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    last = page.agg(F.max(F.struct(stamp.alias("ts"), F.col(spec.key).alias("key"))).alias("last")).first()["last"]
    return cursor if last is None else Cursor(last["ts"], last["key"])


def extract_all(tables: dict[str, DataFrame], cursors: dict[str, Cursor], size: int
                ) -> Iterator[tuple[SourceSpec, DataFrame, Cursor]]:
    """Pages of every configured table that is present until none is left, each with the cursor to store after loading it.

    A page is written before its cursor is taken, so rows that arrive meanwhile can not move its end.
    """
    for name, spec in SOURCES.items():
        if name not in tables:
            continue
        cursor = cursors.get(name, Cursor())
        while True:
            page = written(extract_page(tables[name], spec, cursor, size), f"page-{name}")
            after = next_cursor(page, spec, cursor)
            if spec.cursor is not None and after == cursor:
                break
            yield spec, page, after
            if spec.cursor is None:
                break
            cursor = after
