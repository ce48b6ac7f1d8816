"""One row per key: latest record, distinct rows, first-seen rows.

``row_number() = 1`` is planned with a group limit below the exchange, so every task
sends at most one row per key and a key that holds a large share of all rows costs
no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

_RANK = "_latest_rank"


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keeps the first row per key under ``order``; pass a total order for a stable result."""
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def latest_snapshot(df: DataFrame, keys: Sequence[str], stamp: str = "ingested_at",
                    ties: Sequence[str] = ()) -> DataFrame:
    """Newest row per key. Of rows with one stamp, ``ties`` decide, then the least content, so the order is total."""
    rest = [c for c in df.columns if c not in (*keys, stamp, *ties)]
    order = [F.col(stamp).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in (*ties, *rest)]]
    return latest_by(df, keys, order)


def latest_log_position(df: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    """Drops re-deliveries of one log position."""
    return latest_snapshot(df, ["topic", "partition_id", "kafka_offset"], ties=ties)


def latest_across_sources(df: DataFrame, keys: Sequence[str], event_time: str, load_time: str,
                          ties: Sequence[str] = ()) -> DataFrame:
    rest = [c for c in df.columns if c not in (*keys, event_time, load_time, *ties)]
    order = [F.col(event_time).desc_nulls_last(), F.col(load_time).desc_nulls_last(),
             *[F.col(t).asc_nulls_last() for t in (*ties, *rest)]]
    return latest_by(df, keys, order)


def one_version_per_instant(df: DataFrame) -> DataFrame:
    """Satellite batch: one row per (hub_key, effective_from), latest load, then smallest hash."""
    order = [F.col("load_dts").desc_nulls_last(), F.col("hashdiff").asc()]
    return latest_by(df, ["hub_key", "effective_from"], order)


def first_seen(df: DataFrame, keys: Sequence[str], carry: Sequence[Column] = ()) -> DataFrame:
    """Earliest load and smallest source name per key; rows with a NULL key part are left out. ``carry``: further aggregates."""
    present = df.dropna(subset=list(keys))
    return present.groupBy(*keys).agg(
        F.min("load_dts").alias("load_dts"), F.min("record_source").alias("record_source"), *carry)
