"""Hub and link loading: insert-only tables of business keys and their relations."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash_parts
from .latest import first_seen


@dataclass(frozen=True)
class HubSpec:
    name: str
    source: str
    business_key: str
    single_row: bool = False
    """The source is known to hold one row per business key."""


@dataclass(frozen=True)
class LinkSpec:
    name: str
    source: str
    ends: tuple[tuple[str, str], ...]
    """(prefix of the hub key column, business key column) per end."""
    single_row: bool = False
    """The source is known to hold one row per combination."""


Key = Callable[[Iterable[Column]], Column]


def _seen(source: DataFrame, spec: HubSpec, keys: list[str]) -> DataFrame:
    """First rows per key; a source with one row per key needs no exchange for them."""
    return source.dropna(subset=keys) if spec.single_row else first_seen(source, keys)


def hub_rows(source: DataFrame, spec: HubSpec, existing: DataFrame | None = None, key: Key = hash_parts) -> DataFrame:
    """Hub rows to append: one per business key that ``existing`` does not hold yet.

    ``key=key_text`` gives the texts of the keys in place of their digests.
    """
    seen = _seen(source.select(
        F.col(spec.business_key).cast("string").alias("business_key"), "load_dts", "record_source"),
        spec, ["business_key"])
    if existing is not None:
        seen = seen.join(existing.select("business_key"), "business_key", "left_anti")
    return seen.select(
        key([F.col("business_key")]).alias("hub_key"), "business_key", "load_dts", "record_source")


def link_rows(source: DataFrame, spec: LinkSpec, existing: DataFrame | None = None, key: Key = hash_parts, dealt_by: str | None = None,
              carry: Sequence[Column] = (), by_keys: bool = False) -> DataFrame:
    """Link rows to append: one per combination of business keys not linked yet; ``key`` as for hubs.

    With ``dealt_by``, the prefix of an end that cannot be hot, rows are dealt out by that hub key alone, and a join on it
    needs no further exchange; with ``dealt_by="link"`` they are dealt out by link key, and so meet ``existing`` as they lie.
    ``carry`` are named columns of ``source`` to go with the links, aggregates where ``source`` can have several rows per
    combination; the business keys stay then, too.

    ``by_keys``, for rows dealt out by an end with ``key=key_text`` and business keys that are equal if and only if their key texts
    are: only the texts travel, and the business keys do not stay.
    """
    bks = [bk for _, bk in spec.ends]
    hub_keys = {f"{prefix}_hub_key": key([F.col(bk)]) for prefix, bk in spec.ends}
    link_key = key([F.col(bk) for bk in bks])
    if spec.single_row:
        seen = source.dropna(subset=bks).select(*bks, "load_dts", "record_source", *carry).withColumns(hub_keys)
    elif by_keys:
        dealt = source.dropna(subset=bks).withColumns(hub_keys).repartition(f"{dealt_by}_hub_key")
        seen = first_seen(dealt, list(hub_keys), carry)
        # The text of a link key is made of its ends' texts as of their business keys.
        bks, link_key, hub_keys = [], key([F.col(k) for k in hub_keys]), {k: F.col(k) for k in hub_keys}
    elif dealt_by is None:
        seen = first_seen(source, bks, carry).withColumns(hub_keys)
    else:
        by = "link_key" if dealt_by == "link" else f"{dealt_by}_hub_key"
        keys = {"link_key": link_key, **hub_keys}
        dealt = source.dropna(subset=bks).withColumn(by, keys.pop(by)).repartition(by)
        seen = first_seen(dealt, [by, *bks], carry).withColumns({n: c for n, c in keys.items() if n in hub_keys})
    carried = [*bks, *[c for c in seen.columns if c not in ("link_key", *bks, *hub_keys, "load_dts", "record_source")]] if carry else []
    rows = seen.select(
        "link_key" if "link_key" in seen.columns else link_key.alias("link_key"), *hub_keys, "load_dts", "record_source", *carried)
    if existing is not None:
        rows = rows.join(existing.select("link_key"), "link_key", "left_anti")
    return rows
