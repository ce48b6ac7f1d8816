"""Merging a delta into a table, as pure functions of the old table and the delta.

Keys match null-safely, so a NULL key part finds its row again on the next run.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _aligned(left: DataFrame, right: DataFrame, keys: Sequence[str]):
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") for c in right.columns])
    on = [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys]
    return renamed, on


def rows_without_match(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    renamed, on = _aligned(left, right.select(*keys), keys)
    return left.join(renamed, on, "left_anti")


def rows_with_match(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    renamed, on = _aligned(left, right.select(*keys), keys)
    return left.join(renamed, on, "left_semi")


def upsert(target: DataFrame, delta: DataFrame, keys: Sequence[str],
           update: Sequence[str] | None = None) -> DataFrame:
    """Updates matching rows and inserts the others.

    ``update`` names the columns to overwrite (default: all columns of the delta that are
    no key; empty: leave matching rows alone). Other columns keep the target's value. The
    delta must hold one row per key; a NULL in it overwrites like any other value.
    """
    if update is None:
        update = [c for c in delta.columns if c not in keys]
    if not update:
        return insert_absent(target, delta, keys)
    renamed, on = _aligned(target, delta.withColumn("_hit", F.lit(True)), keys)
    columns = [F.when(F.col("_r__hit"), F.col(f"_r_{c}")).otherwise(target[c]).alias(c)
               if c in update and c in target.columns else target[c] for c in target.columns]
    added = [F.col(f"_r_{c}").alias(c) for c in update if c not in target.columns]
    kept = target.join(renamed, on, "left").select(*columns, *added)
    fresh = rows_without_match(delta, target, keys).select(*keys, *update)
    return kept.unionByName(fresh, allowMissingColumns=True)


def insert_absent(target: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keeps the target and adds delta rows with a new key; repeats inside the delta count once."""
    fresh = rows_without_match(delta.dropDuplicates(list(keys)), target, keys)
    return target.unionByName(fresh, allowMissingColumns=True)


def replace_by_key(target: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Removes every target row whose key occurs in the delta, then appends the delta."""
    kept = rows_without_match(target, delta.select(*keys).distinct(), keys)
    return kept.unionByName(delta, allowMissingColumns=True)


def lookback_start(target: DataFrame | None, column: str, days: int,
                   fallback: datetime = datetime(1970, 1, 1)) -> datetime | date:
    """``max(column) - days`` as a literal, so that the filter reaches the file statistics."""
    if target is None:
        return fallback
    newest = target.agg(F.max(column)).first()[0]
    return fallback if newest is None else newest - timedelta(days=days)


def since(df: DataFrame, column: str, start: datetime | date) -> DataFrame:
    return df.filter(F.col(column) >= F.lit(start))


def incremental_refresh(target: DataFrame, rebuilt: DataFrame, keys: Sequence[str], column: str,
                        days: int) -> DataFrame:
    """One incremental run: recompute the look-back window and replace those keys."""
    delta = since(rebuilt, column, lookback_start(target, column, days))
    return replace_by_key(target, delta, keys)
