"""Sharding by jump consistent hashing: a stable key and the shard count decide, no ring table is kept.

Growing from n to n + 1 shards moves rows only into the new shard, about one row in n + 1.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import or_empty

LAW = "key"

#: Rows of one numbering bucket, about.
BUCKET_ROWS = 250_000

#: Multiplier of the generator of the published method; a fixed value.
JUMP = 2862933555777941757


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each unsigned 64-bit key. A key jumps forward, log(shards) times on average, until past the last shard."""
    state, now, ahead = keys.astype(np.uint64).copy(), np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
    moving = np.arange(len(keys))
    while len(moving):
        now[moving] = ahead[moving]
        state[moving] = state[moving] * np.uint64(JUMP) + np.uint64(1)
        step = float(1 << 31) / ((state[moving] >> np.uint64(33)).astype(np.float64) + 1.0)
        ahead[moving] = ((now[moving] + 1) * step).astype(np.int64)
        moving = moving[ahead[moving] < shards]
    return now


def _jump_column(shards: int):
    @F.pandas_udf("int")
    def of(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(np.int64).view(np.uint64), shards).astype(np.int32))
    return of


def assign_shards(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, size, text_crc32, law, shard, slot and grown_shard (the shard with one more).

    The key is the XXH64 of the id written as text, so the shard of a row depends on nothing else. Slots count from
    0 in each shard without gaps, in the order of a hash of (id, text): buckets of about ``BUCKET_ROWS`` rows are
    numbered on their own and start at the sum of the buckets before them, so no shard passes through one task.

    A null id has a shard of its own choice (the hash of a null); a null or empty text has size 1 and CRC 0. Rows that
    repeat get slots of their own; which of two equal rows has which is open. An empty table gives no rows.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    text = or_empty(text_col)
    rows = docs.select(
        F.col(id_col).alias("_id"), (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.xxhash64(F.col(id_col).cast("string")).alias("_key"))
    buckets = max(1, math.ceil(docs.select(id_col).count() / BUCKET_ROWS))
    # Equal ids with different texts, and a null id, spread by the text.
    placed = rows.select("*", _jump_column(shards)("_key").alias("shard"), _jump_column(shards + 1)("_key").alias("grown_shard"),
                         F.xxhash64("_key", "text_crc32", "size").alias("_order"))
    placed = placed.withColumn("_bucket", F.pmod(F.shiftright("_order", 16), F.lit(buckets)).cast("int"))
    starts = (placed.groupBy("shard", "_bucket").agg(F.count("*").alias("_n"))
              .withColumn("_start", F.sum("_n").over(Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))))
    own = Window.partitionBy("shard", "_bucket").orderBy("_order", "_id")
    return (placed.withColumn("_local", F.row_number().over(own) - 1)
            .join(starts.select("shard", "_bucket", F.coalesce("_start", F.lit(0)).alias("_start")), ["shard", "_bucket"])
            .select(F.col("_id").alias(id_col), "size", "text_crc32", F.lit(LAW).alias("law"), "shard",
                    (F.col("_start") + F.col("_local")).cast("long").alias("slot"), "grown_shard"))
