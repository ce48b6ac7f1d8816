"""Loading of landing folders: a manifest row per file, bad lines kept apart, one run after another."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.latest import latest_by
from ..session import written
from .batches import BATCH, BatchLog
from .files import BAD_LINE, MANIFEST_SCHEMA, READERS, SOURCE, discover, list_files

QUARANTINE_SCHEMA = "source_file string, line string, quarantined_at timestamp"


@dataclass(frozen=True)
class Prefix:
    """A folder of files; ``declared`` is the format of files whose extension names none."""

    folder: str
    schema: str
    declared: str | None = None

    def format_of(self, path: str) -> str | None:
        extension = path.rsplit("/", 1)[-1].rsplit(".", 1)[-1].lower()
        return extension if extension in READERS else self.declared


def newest_manifest(manifest: BatchLog) -> DataFrame:
    """The last entry of each file."""
    return latest_by(manifest.read(with_batch=True), ["file_path"], [F.col(BATCH).desc()]).drop(BATCH)


def load_prefix(spark: SparkSession, prefix: Prefix, manifest: BatchLog, quarantine: BatchLog,
                store: Callable[[DataFrame, int], None], now: datetime, max_files: int | None = None) -> int:
    """Loads the files of one folder that no earlier run finished; returns how many there were.

    ``store`` gets the good rows, with their source file, and the number of the run. A file of no known format is
    quarantined as a whole, with the reason; of a readable file the bad lines are. Only paths pass through the driver.
    """
    run = manifest.last_batch() + 1
    found = written(discover(list_files(spark, prefix.folder), newest_manifest(manifest), max_files), "discovered")
    paths: dict[str | None, list[str]] = {}
    for row in found.select("file_path").collect():
        paths.setdefault(prefix.format_of(row[0]), []).append(row[0])
    if not paths:
        return 0
    good, bad = [], []
    for name, own in sorted((n, p) for n, p in paths.items() if n):
        rows = READERS[name](spark, own, prefix.schema)
        if BAD_LINE in rows.columns:
            rows = written(rows, "landed")
            bad.append(rows.filter(F.col(BAD_LINE).isNotNull()).select(F.col(SOURCE).alias("source_file"), F.col(BAD_LINE).alias("line")))
            rows = rows.filter(F.col(BAD_LINE).isNull()).drop(BAD_LINE)
        good.append(rows)
    empty = spark.createDataFrame([], f"{SOURCE} string")
    loaded = written(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), good), "landed-rows") if good else empty
    if good:
        store(loaded, run)
    stamp = F.lit(now).cast("timestamp")
    lines = reduce(DataFrame.unionByName, bad) if bad else spark.createDataFrame([], "source_file string, line string")
    quarantine.put(lines.withColumn("quarantined_at", stamp), run)
    counts = loaded.groupBy(F.col(SOURCE).alias("file_path")).agg(F.count(F.lit(1)).alias("n"))
    unknown = spark.createDataFrame([(p,) for p in paths.get(None, [])], "file_path string")
    entries = (found.select("file_path", "size_bytes").join(counts, "file_path", "left")
               .join(unknown.withColumn("_unknown", F.lit(True)), "file_path", "left"))
    failed = F.coalesce("_unknown", F.lit(False))
    manifest.put(entries.select(
        "file_path", "size_bytes", F.when(failed, "quarantined").otherwise("loaded").alias("status"),
        F.when(~failed, F.coalesce("n", F.lit(0))).cast("long").alias("rows_loaded"),
        F.when(failed, "unsupported file format").alias("error"), stamp.alias("discovered_at"),
        F.when(~failed, stamp).alias("loaded_at")), run)
    return sum(map(len, paths.values()))


def load_all(spark: SparkSession, prefixes: Sequence[Prefix], manifest: BatchLog, quarantine: BatchLog,
             store: Callable[[Prefix, DataFrame, int], None], now: datetime, max_files: int | None = None) -> dict[str, int]:
    """Every prefix in turn; files loaded per folder."""
    return {p.folder: load_prefix(spark, p, manifest, quarantine, lambda rows, run, p=p: store(p, rows, run), now, max_files)
            for p in prefixes}


def new_logs(spark: SparkSession, path: str) -> tuple[BatchLog, BatchLog]:
    """Manifest and quarantine below ``path``."""
    return BatchLog(spark, f"{path}/manifest", MANIFEST_SCHEMA), BatchLog(spark, f"{path}/quarantine", QUARANTINE_SCHEMA)
