"""Micro-batch ingestion of a message log with stored offsets."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..meta import watermarks
from ..operators.latest import latest_by
from ..session import written
from ..sources.batches import BATCH, BatchLog

POSITION = ("topic", "partition_id", "kafka_offset")


@dataclass(frozen=True)
class Loaded:
    rows_in: int
    rows_out: int
    offsets: dict[int, int]


def load_messages(messages: DataFrame, build: Callable[[DataFrame], DataFrame], target: BatchLog,
                  marks: BatchLog, pipeline: str, now: datetime, limit: int | None = None) -> Loaded:
    """Reads what lies after the stored offsets, stores it as one batch, then the new offsets as another.

    Both batches have the number of the run. A run that dies between them is repeated under the same number and
    replaces its own rows. ``rows_out`` counts rows whose log position was not in the target before. ``limit`` bounds
    one run to the lowest offsets.
    """
    stored = watermarks.get_offsets(watermarks.newest(marks), pipeline)
    run = marks.last_batch() + 1
    fresh = messages
    for partition, offset in stored.items():
        fresh = fresh.filter((F.col("partition") != partition) | (F.col("offset") > offset))
    if limit is not None:
        fresh = fresh.orderBy("offset", "partition").limit(limit)
    batch = written(fresh, "ingest")
    ends = {r["partition"]: r["last"] for r in batch.groupBy("partition").agg(F.max("offset").alias("last")).collect()}
    if not ends:
        return Loaded(0, 0, stored)
    known = target.read(with_batch=True).filter(F.col(BATCH) != run).select(*POSITION)
    built = build(batch)
    once = latest_by(built, POSITION, [F.col(c).asc() for c in built.columns if c not in POSITION])
    rows = written(once.join(known, list(POSITION), "left_anti"), "ingest-rows")
    target.put(rows, run)
    offsets = {**stored, **ends}
    rows_in, rows_out = batch.count(), rows.count()
    marks.put(watermarks.watermark_row(batch.sparkSession, pipeline, watermarks.offsets_text(offsets), now, rows_out), run)
    return Loaded(rows_in, rows_out, offsets)
