"""Point-in-time tables: for every hub and day, the satellite version valid at day end.

The end of a day is one second before midnight. A version that covers no day end of the
spine is dropped before anything is exchanged, so at most one version per day and hub
remains, and those travel as one short array per hub. Pointers are looked up once per run of
days on which they stay the same; days are produced last, and neither the spine nor (hub, day)
pairs are ever shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .merge import replace_by_key

POINTERS = ("load_dts", "hashdiff", "effective_from")


def date_spine(spark: SparkSession, as_of: date, days: int) -> DataFrame:
    """All days from ``as_of - days`` to ``as_of``."""
    bounds = F.sequence(F.lit(as_of - timedelta(days=days)), F.lit(as_of), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(bounds).alias("as_of_date"))


def _day_end(day: Column) -> Column:
    return day.cast("timestamp_ntz") + F.expr("interval 1 day") - F.expr("interval 1 second")


def covered_days(sat: DataFrame, first: date, last: date) -> DataFrame:
    """Adds the first and last spine day at whose end the version is valid; drops the rest."""
    start = F.col("effective_from").cast("timestamp_ntz")
    end = F.col("effective_to").cast("timestamp_ntz")
    start_day, end_day = F.to_date(start), F.to_date(end)
    from_day = F.when(start <= _day_end(start_day), start_day).otherwise(F.date_add(start_day, 1))
    to_day = F.when(end.isNull(), F.lit(last)).when(end > _day_end(end_day), end_day).otherwise(
        F.date_sub(end_day, 1))
    return sat.withColumns({
        "_first_day": F.greatest(from_day, F.lit(first)),
        "_last_day": F.least(to_day, F.lit(last)),
    }).filter(F.col("_first_day") <= F.col("_last_day"))


def _versions_per_hub(sat: DataFrame, first: date, last: date, name: str) -> DataFrame:
    covering = covered_days(sat, first, last)
    version = F.struct("effective_from", "load_dts", "hashdiff", "_first_day", "_last_day")
    return covering.groupBy("hub_key").agg(F.sort_array(F.collect_list(version), asc=False).alias(name))


def pit_runs(hub: DataFrame, satellites: Sequence[tuple[str, DataFrame]], as_of: date, days: int,
             key: Callable[[Column], Column] = lambda c: c) -> DataFrame:
    """Rows of :func:`build_pit` with equal pointers on days in a row as one row, from ``from_day`` to ``to_day``.

    Pointers change only where a version begins or after one ends, so a hub has as many rows as that happens, and one more at most,
    however many days there are.
    """
    first = as_of - timedelta(days=days)
    rows = hub.select("hub_key")
    for alias, sat in satellites:
        rows = rows.join(_versions_per_hub(sat, first, as_of, f"_v_{alias}"), "hub_key", "left")
    none = F.array().cast("array<date>")
    changes = [F.coalesce(F.transform(f"_v_{alias}", change), none) for alias, _ in satellites
               for change in (lambda v: v["_first_day"], lambda v: F.date_add(v["_last_day"], 1))]
    starts = F.array_sort(F.array_distinct(F.filter(F.concat(F.array(F.lit(first)), *changes), lambda d: d <= F.lit(as_of))))
    rows = rows.withColumn("hub_key", key(F.col("hub_key"))).withColumn("_starts", starts)
    run = F.transform("_starts", lambda d, i: F.struct(
        d.alias("from_day"), F.coalesce(F.date_sub(F.get("_starts", i + 1), 1), F.lit(as_of)).alias("to_day")))
    rows = rows.withColumn("_run", F.explode(run))

    out = [F.col("hub_key"), F.col("_run.from_day"), F.col("_run.to_day")]
    for alias, _ in satellites:
        valid = F.filter(F.col(f"_v_{alias}"), lambda v: F.col("_run.from_day").between(v["_first_day"], v["_last_day"]))
        rows = rows.withColumn(f"_p_{alias}", F.get(valid, F.lit(0)))
        out += [F.col(f"_p_{alias}.{p}").alias(f"{alias}_{p}") for p in POINTERS]
    return rows.select(*out)


def days_of(runs: DataFrame) -> DataFrame:
    """One row per day of each run."""
    day = F.explode(F.sequence("from_day", "to_day", F.expr("interval 1 day"))).alias("as_of_date")
    return runs.select("hub_key", day, *[c for c in runs.columns if c not in ("hub_key", "from_day", "to_day")])


def build_pit(hub: DataFrame, satellites: Sequence[tuple[str, DataFrame]], as_of: date, days: int,
              key: Callable[[Column], Column] = lambda c: c) -> DataFrame:
    """One row per hub and day with three pointers per satellite, NULL where none is valid.

    ``key`` is applied to the hub key of the result, once per hub.
    Satellites must hold disjoint intervals per hub key, as the timeline repair leaves them.
    """
    return days_of(pit_runs(hub, satellites, as_of, days, key))


def refresh_pit(existing: DataFrame, hub: DataFrame, satellites: Sequence[tuple[str, DataFrame]], as_of: date,
                days: int, lookback: int = 7) -> DataFrame:
    """Existing table with the last ``lookback`` days recomputed, and all days of hubs that are new."""
    newest = existing.agg(F.max("as_of_date")).first()[0]
    if newest is None:
        return build_pit(hub, satellites, as_of, days)
    seen = existing.select("hub_key").distinct()
    recent = min(days, (as_of - newest).days + lookback)
    fresh = build_pit(hub.join(seen, "hub_key", "left_semi"), satellites, as_of, recent).unionByName(
        build_pit(hub.join(seen, "hub_key", "left_anti"), satellites, as_of, days))
    return replace_by_key(existing, fresh, ["hub_key", "as_of_date"])
