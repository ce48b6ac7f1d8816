"""Stored high-water marks of the ingestion pipelines."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.latest import latest_by
from ..operators.merge import upsert
from ..sources.batches import BATCH, BatchLog

SCHEMA = "pipeline_name string, watermark_value string, last_run_at timestamp, records_processed bigint, notes string"
FALLBACK = "1970-01-01T00:00:00+00:00"


def get_watermark(table: DataFrame, pipeline: str, fallback: str = FALLBACK) -> str:
    row = table.filter(F.col("pipeline_name") == pipeline).select("watermark_value").first()
    return row[0] if row and row[0] else fallback


def watermark_row(spark: SparkSession, pipeline: str, value: str, at: datetime, records: int | None = None,
                  notes: str | None = None) -> DataFrame:
    return spark.createDataFrame([(pipeline, value, at, records, notes)], SCHEMA)


def newest(marks: BatchLog) -> DataFrame:
    """The last mark of each pipeline."""
    return latest_by(marks.read(with_batch=True), ["pipeline_name"], [F.col(BATCH).desc()]).drop(BATCH)


def set_watermarks(table: DataFrame, rows: DataFrame) -> DataFrame:
    return upsert(table, rows, ["pipeline_name"])


def get_offsets(table: DataFrame, pipeline: str) -> dict[int, int]:
    """Offsets per partition; unreadable text counts as none."""
    try:
        return {int(k): int(v) for k, v in json.loads(get_watermark(table, pipeline, "{}")).items()}
    except (ValueError, AttributeError):
        return {}


def offsets_text(offsets: dict[int, int]) -> str:
    return json.dumps({str(k): v for k, v in sorted(offsets.items())})


def last_offsets(log: DataFrame) -> DataFrame:
    """Highest offset per topic and partition."""
    return log.groupBy("topic", "partition_id").agg(F.max("kafka_offset").alias("last_offset"))


def merged_offsets(stored: DataFrame, loaded: DataFrame) -> DataFrame:
    """Offset map per topic as JSON: the loaded offset wins over the stored one.

    Both inputs hold one row per topic and partition, so the collected map is as long as
    the number of partitions.
    """
    tagged = stored.withColumn("_new", F.lit(0)).unionByName(loaded.withColumn("_new", F.lit(1)))
    chosen = tagged.groupBy("topic", "partition_id").agg(F.max_by("last_offset", "_new").alias("last_offset"))
    entry = F.struct(F.col("partition_id").cast("string"), F.col("last_offset"))
    return chosen.groupBy("topic").agg(
        F.to_json(F.map_from_entries(F.sort_array(F.collect_list(entry)))).alias("watermark_value"))
