"""Bridges: a link joined with its hubs, one flat row per link; and hub, link and version of one source row side by side."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash_parts
from .keys import HubSpec, Key, LinkSpec
from .scd2 import SatSpec


def bridge_key(*columns: str):
    return hash_parts([F.col(c) for c in columns]).alias("bridge_key")


def bridge_rows(link: DataFrame, hubs: Mapping[str, DataFrame], extra: Sequence[str] = ()) -> DataFrame:
    """A bridge without its own key; the keys may be key texts."""
    rows = link
    for prefix, hub in hubs.items():
        rows = rows.join(hub.select(F.col("hub_key").alias(f"{prefix}_hub_key")), f"{prefix}_hub_key")
    fks = [f"{prefix}_hub_key" for prefix in hubs]
    return rows.select("link_key", *fks, *extra, "load_dts", "record_source")


def build_bridge(link: DataFrame, hubs: Mapping[str, DataFrame], extra: Sequence[str] = (),
                 key: Callable[[Column], Column] = lambda c: c) -> DataFrame:
    """``hubs`` maps a prefix to the hub that ``<prefix>_hub_key`` of the link points to; ``key`` makes hash keys of theirs."""
    fks = [f"{prefix}_hub_key" for prefix in hubs]
    rows = bridge_rows(link, hubs, extra).withColumns({c: key(F.col(c)) for c in ("link_key", *fks)})
    return rows.select(bridge_key("link_key", *fks), "*")


def side_by_side(source: DataFrame, hub: HubSpec, link: LinkSpec, sat: SatSpec, key: Key = hash_parts) -> DataFrame:
    """Hub row, other ends of the link and version of every business key of a source with one row per key.

    What the three tables say of a key stands in one row of the source, so they need not meet in joins. Where an end is missing
    there is no link and its ends are NULL; a row without change hash or instant has no version (``has_version``) and NULL in
    its columns.
    """
    linked = reduce(Column.__and__, [F.col(bk).isNotNull() for _, bk in link.ends])
    ends = [F.when(linked, key([F.col(bk)])).alias(f"{prefix}_hub_key") for prefix, bk in link.ends if bk != hub.business_key]
    versioned = F.col("hashdiff").isNotNull() & F.col("effective_from").isNotNull()
    of_version = [F.when(versioned, F.col(c)).alias(c) for c in ("load_dts", "effective_from", "record_source", *sat.columns)]
    bk = F.col(hub.business_key).cast("string")
    return source.dropna(subset=[hub.business_key]).select(
        key([bk]).alias("hub_key"), bk.alias("business_key"), *ends, versioned.alias("has_version"), *of_version)
