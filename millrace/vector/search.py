"""Exact inner-product search over stored vectors.

Queries are cut into blocks of bounded size, and each block is a job of its own. A task
multiplies it with one Arrow batch of the corpus at a time and keeps the best ``k`` per
query, so what leaves a task is k rows per query. Corpus vectors never meet each other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import written

BLOCK_VALUES = 2_000_000


def l2_normalise(c: Column) -> Column:
    """Unit vector; a zero vector stays as it is."""
    numbers = F.transform(c, lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(numbers, F.lit(0.0), lambda acc, x: acc + x * x))
    return F.transform(numbers, lambda x: F.when(norm > 0, x / norm).otherwise(x))


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """Vectors of one width as the rows of a matrix, without a Python object per number."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _best_in_batches(numbers: np.ndarray, matrix: np.ndarray, k: int):
    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pd.DataFrame | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            corpus = _matrix(batch.column("embedding"), matrix.shape[1])
            keys = batch.column("vec_id").to_numpy(zero_copy_only=False)
            frames = [] if kept is None else [kept]
            for start in range(0, len(numbers), 256):
                block = corpus @ matrix[start:start + 256].T
                if len(keys) > k:
                    # Ties at the k-th score are kept here; the final ranking cuts them by vec_id.
                    floor = np.partition(block, len(keys) - k, axis=0)[len(keys) - k]
                    rows, cols = np.nonzero(block >= floor)
                else:
                    rows, cols = np.nonzero(np.ones_like(block, dtype=bool))
                frames.append(pd.DataFrame({"_query": numbers[start + cols], "vec_id": keys[rows],
                                            "score": block[rows, cols]}))
            found = pd.concat(frames, ignore_index=True).sort_values(
                ["_query", "score", "vec_id"], ascending=[True, False, True])
            kept = found.groupby("_query", sort=False).head(k)
        if kept is not None:
            yield pa.RecordBatch.from_pandas(kept, preserve_index=False)
    return best


def top_k(corpus: DataFrame, queries: DataFrame, k: int, block_values: int = BLOCK_VALUES) -> DataFrame:
    """Best ``k`` corpus rows (``vec_id, embedding``) per query row (``query_id, embedding``), ties by vec_id.

    Every query row is numbered and put into a block by a hash of its number; a block of about ``block_values``
    numbers is one job over the corpus whose result is written, so the driver holds one block at a time. Rows that
    repeat an id, or have none, are queries of their own. A vector is compared with those of its own width; one that
    is NULL or empty is compared with none.
    """
    spark = corpus.sparkSession
    numbered = written(queries.select("query_id", "embedding").filter(F.size("embedding") > 0).withColumn(
        "_query", F.monotonically_increasing_id()), "queries")
    found = []
    for shape in numbered.groupBy(F.size("embedding").alias("width")).agg(F.count(F.lit(1)).alias("n")).orderBy("width").collect():
        width, blocks = shape["width"], math.ceil(shape["n"] * shape["width"] / block_values)
        same = numbered.filter(F.size("embedding") == width)
        vectors = corpus.filter(F.size("embedding") == width).select("vec_id", "embedding")
        schema = f"_query bigint, vec_id {corpus.schema['vec_id'].dataType.simpleString()}, score double"
        for block in range(blocks):
            own = same.filter(F.pmod(F.xxhash64("_query"), F.lit(blocks)) == block).select("_query", "embedding").toPandas()
            if len(own):
                matrix = np.stack(own["embedding"].to_numpy()).astype(np.float64)
                found.append(written(vectors.mapInArrow(_best_in_batches(own["_query"].to_numpy(), matrix, k), schema), "block-scores"))
    if not found:
        return numbered.limit(0).select("query_id", F.lit(None).cast(corpus.schema["vec_id"].dataType).alias("vec_id"),
                                        F.lit(0.0).alias("score"), F.lit(0).alias("rank"))
    ranked = W.partitionBy("_query").orderBy(F.col("score").desc(), F.col("vec_id").asc())
    best = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
    return best.join(numbered.select("_query", "query_id"), "_query").select("query_id", "vec_id", "score", "rank")


def label_centroids(corpus: DataFrame) -> DataFrame:
    """Unit mean vector per label as queries; summed per position before anything is collected."""
    parts = corpus.select("label", F.posexplode("embedding").alias("pos", "x")).groupBy("label", "pos").agg(
        F.avg(F.col("x").cast("double")).alias("x"))
    vectors = parts.groupBy("label").agg(F.sort_array(F.collect_list(F.struct("pos", "x"))).alias("_v"))
    return vectors.select(F.col("label").alias("query_id"), l2_normalise(F.col("_v.x")).alias("embedding"))
