"""Helpers shared by the corpus operators: tables, written intermediate tables, Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import shared_dir

#: Rows of one Arrow batch; with long documents this bounds the memory of a Python worker.
BATCH_ROWS = 1000
#: Bytes of text that an operator sees at once, but for one longer text.
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_ROWS`` rows; a smaller setting of the session stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the folder that all executors share."""
    return f"{shared_dir(spark)}/llm/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder: computed once, safe from lost executors."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def or_empty(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def by_bytes(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``limit`` bytes in a text column, or one row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    low = 0
    while low < batch.num_rows:
        done = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield batch.slice(low, high - low)
        low = high


def mapped(df: DataFrame, f: Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table | None], schema: str, text: str = "text") -> DataFrame:
    """``f`` over Arrow batches with at most ``BATCH_BYTES`` in column ``text``, or one row."""
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, text, BATCH_BYTES):
                out = f(part)
                if isinstance(out, pa.Table):
                    yield from out.to_batches()
                elif out is not None:
                    yield out

    return df.mapInArrow(run, schema)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all strings of a column on end, and their n + 1 offsets. A null is empty."""
    filled = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(filled, pa.ChunkedArray):
        filled = filled.combine_chunks()
    offsets = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset:filled.offset + len(filled) + 1]
    data = filled.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]] if len(offsets) else whole, offsets - offsets[0] if len(offsets) else np.zeros(1, np.int64)


def byte_texts(column: pa.Array) -> list[bytes]:
    """The UTF-8 form of each string; a null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]
