"""How far ingestion is behind its source."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def offset_lag(high: DataFrame, stored: DataFrame) -> DataFrame:
    """Messages not read yet per topic and partition; a partition without offset counts from 0."""
    last = stored.select("topic", "partition_id", "last_offset")
    rows = high.join(last, ["topic", "partition_id"], "left")
    start = F.greatest(F.coalesce("last_offset", F.lit(-1)) + 1, F.lit(0))
    return rows.select("topic", "partition_id", "high_offset", "last_offset",
                       F.greatest(F.col("high_offset") - start, F.lit(0)).alias("lag"))


def ingestion_lag(log: DataFrame, stamp: str, now: datetime, *by: str) -> DataFrame:
    """Seconds between the clock and the newest event, never negative."""
    clock = F.lit(now).cast(log.schema[stamp].dataType)
    newest = log.groupBy(*by).agg(F.max(stamp).alias("newest"))
    return newest.withColumn("lag_seconds", F.greatest(
        F.timestamp_diff("SECOND", F.col("newest"), clock), F.lit(0).cast("long")))
