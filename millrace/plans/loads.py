"""The raw vault kept by loads instead of full builds.

Hubs and links are logs of insert-only batches: a load appends the keys that no other load holds, and a load that is repeated
replaces its own batch. Satellites are partitioned by bucket of the hub key. They keep every observation, so a late
one falls into place whatever was collapsed before, and the finished timeline beside them; readers sort nothing. A load reads only
the buckets that its keys fall into. It rewrites those in which a stored hub has a new observation, appends hubs that are new to
the others, and touches no bucket without a new observation. A file marks a load until its timeline is done, so the next one
takes up what a broken one has left. Point-in-time tables follow from what a load says it
changed: the touched hubs and the first day that looks different for each. They keep runs of days with the same pointers, not days.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import replace
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import hash_parts
from ..operators.keys import HubSpec, Key, LinkSpec, hub_rows, link_rows
from ..operators.latest import one_version_per_instant
from ..operators.pit import POINTERS, days_of, pit_runs
from ..operators.scd2 import SatSpec, first_versions, recompute_timeline
from ..session import written
from ..sources.batches import BATCH, BatchLog
from ..sources.partitions import PartitionedTable, bucket_of, values_of

Spec = HubSpec | LinkSpec | SatSpec

_OBSERVATION = ["hub_key", "effective_from", "load_dts", "hashdiff"]
#: Column of stored observations that names the load they came with.
_LOAD = "load_id"


BUCKETS = 16


def _schema_of(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        raise ValueError("nothing has been loaded") from e


class VaultTable:
    """One hub or link below ``path``."""

    def __init__(self, spark: SparkSession, path: str, spec: HubSpec | LinkSpec, key: Key = hash_parts):
        # A repeated load may bring a key twice, whatever staging does.
        self.spec, self.spark, self.path, self.key = replace(spec, single_row=False), spark, path, key
        self._log: BatchLog | None = None

    def _rows(self, staged: DataFrame, known: DataFrame | None) -> DataFrame:
        if isinstance(self.spec, HubSpec):
            return hub_rows(staged, self.spec, known, self.key)
        return link_rows(staged, self.spec, known, self.key, dealt_by="link")

    def load(self, staged: DataFrame, number: int) -> None:
        """Appends what ``staged`` has and no other load holds, as batch ``number``."""
        self._log = self._log or BatchLog(self.spark, self.path, self._rows(staged, None).schema)
        others = self._log.read(with_batch=True).filter(F.col(BATCH) != number).drop(BATCH)
        self._log.put(self._rows(staged, others), number)

    def rows(self) -> DataFrame:
        """The table after all loads, also those of other sessions."""
        if self._log is None:
            self._log = BatchLog(self.spark, self.path, _schema_of(self.spark, self.path).drop(BATCH).schema)
        return self._log.read()


class Marks:
    """Names that are kept as empty files in a folder of any file system that Spark writes to."""

    def __init__(self, spark: SparkSession, path: str):
        self._path_of = lambda name="": spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}" if name else path)
        self._files = self._path_of().getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self) -> list[str]:
        folder = self._path_of()
        return sorted(f.getPath().getName() for f in self._files.listStatus(folder)) if self._files.exists(folder) else []

    def add(self, name: str) -> None:
        self._files.create(self._path_of(name)).close()

    def remove(self, names: Sequence[str]) -> None:
        for name in names:
            self._files.delete(self._path_of(name), False)


class SatelliteTable:
    """One satellite below ``path``: all observations and the timeline, both by bucket of the hub key."""

    def __init__(self, spark: SparkSession, path: str, spec: SatSpec, buckets: int = BUCKETS):
        # A source that holds one row per key within a load can hold another one in the next.
        self.spec, self.spark, self.path, self.buckets = replace(spec, single_version=False), spark, path, buckets
        self._tables: tuple[PartitionedTable, PartitionedTable] | None = None

    def _open(self, rows: DataFrame) -> tuple[PartitionedTable, PartitionedTable]:
        """``rows`` of a timeline, for their columns."""
        if self._tables is None:
            stored = {"observations": rows.withColumn(_LOAD, F.lit("")), "timeline": rows}
            self._tables = tuple(PartitionedTable(self.spark, f"{self.path}/{part}", "bucket", kept.schema) for part, kept in stored.items())
        return self._tables

    def load(self, staged: DataFrame, number: int = 0) -> DataFrame:
        """Adds observations and renews the timeline; (hub_key, since): what changed, from which day on.

        An observation that is stored already adds nothing, so a load may be repeated, also one that broke off; ``number`` is not needed.
        """
        incoming = first_versions(staged, self.spec).withColumn("bucket", bucket_of("hub_key", self.buckets))
        seen, timeline = self._open(incoming)
        open_loads, this = Marks(self.spark, f"{self.path}/open"), uuid.uuid4().hex
        broken = open_loads.names()
        touched = values_of(staged.dropna(subset=["hub_key", "hashdiff", "effective_from"]).select(bucket_of("hub_key", self.buckets)), "bucket")
        open_loads.add(this)
        # Satellite keys are complete, so plain equality finds observations that are stored already.
        seen.append(incoming.join(seen.read(touched).select(*_OBSERVATION), _OBSERVATION, "left_anti").withColumn(_LOAD, F.lit(this)))
        fresh = seen.read(None if broken else touched).filter(F.col(_LOAD).isin(this, *broken))
        buckets = values_of(fresh, "bucket")
        # What a broken load has done to the timeline is not known, so its buckets are made anew.
        renewed = buckets if broken or not buckets else values_of(timeline.read(buckets).join(fresh.select("hub_key"), "hub_key", "left_semi"), "bucket")
        new = [b for b in buckets if b not in renewed]
        if renewed:
            timeline.replace_all(self._timeline(one_version_per_instant(seen.read(renewed))))
        if new:
            # Hubs without stored observations; those of one load are one per instant.
            timeline.append(self._timeline(fresh.filter(F.col("bucket").isin(new))))
        open_loads.remove([this, *broken])
        return fresh.groupBy("hub_key").agg(F.to_date(F.min("effective_from")).alias("since"))

    @staticmethod
    def _timeline(observations: DataFrame) -> DataFrame:
        """A hub with one observation has its timeline in it; only the others are dealt out in order."""
        rows = observations.drop(_LOAD)
        several = written(rows.groupBy("hub_key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("hub_key"), "hubs-with-versions")
        if several.isEmpty():
            return rows
        return rows.join(several, "hub_key", "left_anti").unionByName(recompute_timeline(rows.join(several, "hub_key", "left_semi")))

    def rows(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """The finished timeline, or some buckets of it, as all loads left it, also those of other sessions."""
        if self._tables is None:
            self._open(_schema_of(self.spark, f"{self.path}/timeline"))
        return self._tables[1].read(buckets).drop("bucket")


class PitTable:
    """A point-in-time table over kept satellites, by bucket of the hub key. Runs of days with the same pointers are one stored row."""

    def __init__(self, spark: SparkSession, path: str, satellites: Sequence[tuple[str, SatelliteTable]], days: int):
        """All ``satellites`` have the same number of buckets; ``days`` is how far the table looks back."""
        self.spark, self.satellites, self.days, self.buckets = spark, satellites, days, satellites[0][1].buckets
        pointers = "".join(f", {a}_{p} {t}" for a, _ in satellites for p, t in zip(POINTERS, ("timestamp", "string", "timestamp")))
        empty = spark.createDataFrame([], f"hub_key string, from_day date, to_day date{pointers}, bucket int")
        self.table = PartitionedTable(spark, path, "bucket", empty.schema)
        self.as_of: date | None = None

    def _built(self, hub: DataFrame, buckets: Sequence[int] | None, as_of: date, days: int) -> DataFrame:
        versions = [(alias, sat.rows(buckets)) for alias, sat in self.satellites]
        return pit_runs(hub.select("hub_key"), versions, as_of, days).withColumn("bucket", bucket_of("hub_key", self.buckets))

    def refresh(self, changed: DataFrame, hub: DataFrame, as_of: date) -> None:
        """After a load: ``changed`` (hub_key, since) is what it returned, ``hub`` all hubs, ``as_of`` the last day wanted.

        Days that have passed since are added for all hubs by an append. Of changed hubs the days from ``since`` on are renewed, of hubs
        that are new all days; only their buckets are rewritten, and their other rows are copied as they are.
        """
        first = as_of - timedelta(days=self.days)
        newest = self.table.read().agg(F.max("to_day")).first()[0]
        keyed = hub.select("hub_key", bucket_of("hub_key", self.buckets))
        if newest is not None and newest < as_of:
            there = self.table.read().filter(F.col("to_day") == newest).select("hub_key")
            self.table.append(written(self._built(keyed.join(there, "hub_key", "left_semi"), None, as_of, (as_of - newest).days - 1), "new-days"))
        known = self.table.read().filter(F.lit(as_of).between(F.col("from_day"), F.col("to_day"))).select("hub_key")
        fresh = keyed.join(known, "hub_key", "left_anti").select("hub_key", F.lit(first).alias("since"))
        todo = written(changed.select("hub_key", "since").join(fresh, "hub_key", "left_anti").unionByName(fresh)
                       .withColumn("bucket", bucket_of("hub_key", self.buckets)), "changed-hubs")
        touched, since = values_of(todo, "bucket"), todo.select("hub_key", "since")
        there = self.table.read(touched).join(since, "hub_key", "left")
        last = F.when(F.col("since").isNotNull(), F.least("to_day", F.date_sub("since", 1))).otherwise(F.col("to_day"))
        rest = _cut(there.withColumn("to_day", last), F.lit(first)).drop("since")
        renewed = _cut(self._built(todo, touched, as_of, self.days).join(since, "hub_key"), F.col("since")).drop("since")
        self.table.replace(touched, rest.unionByName(renewed))
        self.as_of = as_of

    def rows(self, key: Callable[[Column], Column] = lambda c: c) -> DataFrame:
        """One row per hub and day of the look-back; ``key`` is applied to the hub key of a run, not of each day."""
        newest = self.as_of or self.table.read().agg(F.max("to_day")).first()[0]
        runs = self.table.read().drop("bucket")
        wanted = runs if newest is None else _cut(runs, F.lit(newest - timedelta(days=self.days)))
        return days_of(wanted.withColumn("hub_key", key(F.col("hub_key"))))


def _cut(runs: DataFrame, first: Column) -> DataFrame:
    """What ``runs`` have from day ``first`` on."""
    return runs.withColumn("from_day", F.greatest("from_day", first)).filter(F.col("from_day") <= F.col("to_day"))


def vault_table(spark: SparkSession, path: str, spec: Spec, key: Key = hash_parts) -> VaultTable | SatelliteTable:
    """``key`` makes the keys of hubs and links; those of satellites come with their rows."""
    return SatelliteTable(spark, path, spec, buckets=4) if isinstance(spec, SatSpec) else VaultTable(spark, path, spec, key)


def key_columns(spec: Spec) -> list[str]:
    """Staging columns that decide which rows of a table belong together."""
    if isinstance(spec, HubSpec):
        return [spec.business_key]
    return [bk for _, bk in spec.ends] if isinstance(spec, LinkSpec) else ["hub_key"]
