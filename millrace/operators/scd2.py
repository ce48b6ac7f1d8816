"""Versioned satellites: change detection, timeline repair, late data.

Intervals are ``[effective_from, effective_to)``; an open version has no end.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .latest import latest_by, one_version_per_instant
from .ordered import Series, segmented, unsegmented, with_last_known, with_neighbours

HEAD = ("hub_key", "hashdiff", "load_dts", "effective_from", "effective_to", "is_current", "record_source")


@dataclass(frozen=True)
class SatSpec:
    name: str
    source: str
    columns: tuple[str, ...]
    single_version: bool = False
    """The source is known to hold one row per hub key."""


_TIES = ("load_dts", "hashdiff")


#: Version order of a satellite.
VERSIONS = Series(("hub_key",), "effective_from", _TIES)


def _opened(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    end_type = rows.schema["effective_from"].dataType
    return rows.withColumns({
        "effective_to": F.lit(None).cast(end_type), "is_current": F.lit(True)}).select(*HEAD, *columns)


def first_versions(source: DataFrame, spec: SatSpec) -> DataFrame:
    """Rows of a first build, before the timeline is computed."""
    complete = source.dropna(subset=["hub_key", "hashdiff", "effective_from"])
    rows = complete if spec.single_version else one_version_per_instant(complete)
    return _opened(rows, spec.columns)


def new_versions(source: DataFrame, target: DataFrame, spec: SatSpec, *, dedupe: bool = True) -> DataFrame:
    """Versions to append to ``target``.

    A source row is left out when the target has a version at the same instant, or when
    the version before it carries the same hash. Rows of one batch are compared with the
    target only, never with each other. ``dedupe=False`` gives the plain merge detector.
    """
    rows = first_versions(source, spec) if dedupe else _opened(source, spec.columns)
    versions = target.select(
        "hub_key", "effective_from", "load_dts",
        F.struct("effective_from", "hashdiff").alias("_version"), F.lit(0).alias("_incoming"))
    merged = rows.withColumn("_incoming", F.lit(1)).unionByName(versions, allowMissingColumns=True)
    order = VERSIONS.ordered_by("effective_from", ("_incoming", "load_dts"))
    known = with_last_known(merged, order, "_prior", "_version").filter(F.col("_incoming") == 1)
    same_instant = F.coalesce(F.col("_prior.effective_from") == F.col("effective_from"), F.lit(False))
    same_hash = F.coalesce(F.col("_prior.hashdiff") == F.col("hashdiff"), F.lit(False))
    return known.filter(~same_instant & ~same_hash).select(*HEAD, *spec.columns)


def close_timeline(rows: DataFrame, series: Series = VERSIONS) -> DataFrame:
    """Ends every version where the next one starts; the last one stays open."""
    columns = rows.columns
    nexts = with_neighbours(rows, series, following={"_next": "effective_from"})
    return nexts.withColumns({
        "effective_to": F.col("_next"), "is_current": F.col("_next").isNull()}).select(*columns)


def end_date_only(rows: DataFrame) -> DataFrame:
    """Closes versions without collapsing repeats; ties at one instant go by hash."""
    return close_timeline(rows, VERSIONS.ordered_by("effective_from", ("hashdiff",)))


def collapse_repeats(rows: DataFrame) -> DataFrame:
    """Drops a version that repeats the hash of the version right before it."""
    prior = with_neighbours(rows, VERSIONS, previous={"_prior_hash": "hashdiff"})
    repeated = F.coalesce(F.col("_prior_hash") == F.col("hashdiff"), F.lit(False))
    return prior.filter(~repeated).drop("_prior_hash")


def recompute_timeline(rows: DataFrame) -> DataFrame:
    """Drops repeats and closes versions; both steps share one deal of the rows."""
    return unsegmented(close_timeline(collapse_repeats(segmented(rows, VERSIONS))))


def build_satellite(source: DataFrame, spec: SatSpec) -> DataFrame:
    """Full build. One row per hub key is its own finished timeline and needs no exchange."""
    rows = first_versions(source, spec)
    return rows if spec.single_version else recompute_timeline(rows)


def load_satellite(target: DataFrame, source: DataFrame, spec: SatSpec) -> DataFrame:
    """Target after one more load; only timelines of touched hub keys are recomputed."""
    delta = new_versions(source, target, spec)
    touched = source.select("hub_key").distinct()
    affected = target.join(touched, "hub_key", "left_semi").unionByName(delta, allowMissingColumns=True)
    untouched = target.join(touched, "hub_key", "left_anti")
    return untouched.unionByName(recompute_timeline(affected), allowMissingColumns=True)


def lossless_timeline(observations: DataFrame, spec: SatSpec) -> DataFrame:
    """Timeline derived on read from every observed row, whatever the order of loads."""
    return recompute_timeline(first_versions(observations, spec))


def close_and_insert(target: DataFrame, inbox: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Imperative variant: close the current version, insert the new one, repair the chain.

    ``inbox`` has one row per hub key. A version at an instant that exists already
    replaces it when it was loaded later, so no key ends up with two current rows.
    """
    current = target.filter("is_current").select("hub_key", F.col("hashdiff").alias("_current_hash"))
    changed = inbox.join(current, "hub_key", "left").filter(
        ~F.col("hashdiff").eqNullSafe(F.col("_current_hash")))
    merged = target.unionByName(_opened(changed, columns), allowMissingColumns=True)
    kept = latest_by(merged, ["hub_key", "effective_from"],
                     [F.col("load_dts").desc_nulls_last(), F.col("hashdiff").asc()])
    return close_timeline(kept)
