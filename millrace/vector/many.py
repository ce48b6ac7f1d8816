"""Exact inner-product top-k of many queries against a stored corpus.

Corpus rows go to the nearest of a bounded number of pivots and, inside that cell, to parts by their angle to the pivot.
The angle between a query and a row is at least the difference of their angles to a pivot, so a part's range of angles
and lengths bounds every score in it. A query is first answered by one part of its nearest cell; its k-th score there is a
floor, and then it goes only to parts whose bound reaches the floor. Parts and queries meet by a shuffle on the
part: rows of a part come first, its queries stream past them, and a part that many queries reach is copied for slices
of these. Only the pivots pass through the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import written

PIVOTS = 64
#: Steps of the angle by which a cell is cut, rows of a part and queries that meet one copy of a part.
STEPS, PART_ROWS, SLICE_QUERIES = 256, 8192, 100_000
#: Scores are compared at this many decimals; below that they are ties.
DIGITS = 9
#: Queries that are multiplied with a part at once.
BLOCK = 256


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _angles(matrix: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Angles to all pivots, and lengths. A zero vector is at a right angle to everything."""
    norm = np.sqrt((matrix * matrix).sum(axis=1))
    unit = matrix / np.where(norm > 0, norm, 1.0)[:, None]
    return np.arccos(np.clip(unit @ pivots.T, -1.0, 1.0)), norm


def _to_cells(pivots: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            angles, norm = _angles(_matrix(batch.column("embedding"), pivots.shape[1]), pivots)
            cell = angles.argmin(axis=1) if len(angles) else np.zeros(0, np.int64)
            yield pa.record_batch([batch.column("vec_id"), batch.column("embedding"), pa.array(cell.astype(np.int32)),
                                   pa.array(angles[np.arange(len(cell)), cell]), pa.array(norm)],
                                  ["vec_id", "embedding", "_cell", "_angle", "_norm"])
    return run


def _to_pivots(pivots: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            angles, norm = _angles(_matrix(batch.column("embedding"), pivots.shape[1]), pivots)
            offsets = np.arange(0, angles.size + 1, len(pivots), dtype=np.int32)
            yield pa.record_batch([batch.column("_query"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(angles.ravel())), pa.array(norm)],
                                  ["_query", "_angles", "_length"])
    return run


def _best(k: int, width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Best k rows of the part that stands before each query. A task holds one part and one batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, ids, rows, corpus, keys = None, [], [], None, None
        for batch in batches:
            marks = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("_part", "_slice", "_kind")], axis=1)
            starts = np.flatnonzero(np.append(True, (marks[1:] != marks[:-1]).any(axis=1))) if len(marks) else []
            for low, high in zip(starts, [*starts[1:], len(marks)]):
                some = batch.slice(low, high - low)
                if tuple(marks[low, :2]) != group:
                    group, ids, rows, corpus = tuple(marks[low, :2]), [], [], None
                if not marks[low, 2]:
                    ids.append(some.column("vec_id").to_numpy(zero_copy_only=False).astype(np.int64))
                    rows.append(_matrix(some.column("embedding"), width))
                    continue
                if corpus is None:
                    keys, corpus = np.concatenate(ids), np.concatenate(rows)
                queries, asked = _matrix(some.column("embedding"), width), some.column("_query").to_numpy(zero_copy_only=False).astype(np.int64)
                for start in range(0, len(asked), BLOCK):
                    block = np.round(queries[start:start + BLOCK] @ corpus.T, DIGITS)
                    least = np.partition(block, len(keys) - k, axis=1)[:, len(keys) - k] if len(keys) > k else np.full(len(block), -np.inf)
                    query, row = np.nonzero(block >= least[:, None])
                    order = np.lexsort((keys[row], -block[query, row], query))
                    query, row = query[order], row[order]
                    place = np.arange(len(query)) - np.searchsorted(query, query)
                    query, row = query[place < k], row[place < k]
                    yield pa.record_batch([pa.array(asked[start + query]), pa.array(keys[row]), pa.array(block[query, row])], ["_query", "vec_id", "score"])
    return run


def _bound(angle: Column, length: Column) -> Column:
    """No row of a part has a higher score with a query of this angle to the pivot; some slack covers rounding."""
    gap = F.greatest(F.lit(0.0), angle - F.col("_high"), F.col("_low") - angle)
    share = F.cos(F.greatest(F.lit(0.0), gap - F.lit(1e-6)))
    norm = F.when(share >= 0, F.col("_longest")).otherwise(F.col("_shortest"))
    return length * norm * share + 1e-8 * (1 + length * F.col("_longest"))


def _meet(pairs: DataFrame, placed: DataFrame, vectors: DataFrame, k: int, width: int) -> DataFrame:
    """Best k rows per pair of a query and a part."""
    slices = pairs.groupBy("_part").agg(F.ceil(F.count("*") / F.lit(SLICE_QUERIES)).cast("int").alias("_slices"))
    rows = (placed.join(slices, "_part").select("_part", F.explode(F.sequence(F.lit(0), F.col("_slices") - 1)).alias("_slice"), F.lit(0).alias("_kind"),
                                                F.lit(None).cast("bigint").alias("_query"), "vec_id", "embedding"))
    asked = (pairs.join(slices, "_part").join(vectors, "_query")
             .select("_part", F.pmod(F.xxhash64("_query"), F.col("_slices")).cast("int").alias("_slice"), F.lit(1).alias("_kind"), "_query",
                     F.lit(None).cast("bigint").alias("vec_id"), "embedding"))
    return (rows.unionByName(asked).repartition("_part", "_slice").sortWithinPartitions("_part", "_slice", "_kind")
            .mapInArrow(_best(k, width), "_query bigint, vec_id bigint, score double"))


def _finite(df: DataFrame, *columns: str) -> DataFrame:
    """Vectors as doubles; without rows that have no vector, or one with a component that is null or not finite."""
    numbers = F.transform("embedding", lambda x: x.cast("double"))
    return df.select(*columns, numbers.alias("embedding")).filter(
        (F.size("embedding") > 0) & F.forall("embedding", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))))


def _one_width(corpus: DataFrame, vectors: DataFrame, k: int, width: int) -> DataFrame | None:
    drawn = corpus.orderBy(F.xxhash64("vec_id"), "vec_id", "embedding").limit(PIVOTS).toArrow()
    if not drawn.num_rows:
        return None
    pivots = _matrix(drawn["embedding"].combine_chunks(), width)
    norm = np.sqrt((pivots * pivots).sum(axis=1))
    pivots = np.unique(pivots[norm > 0] / norm[norm > 0, None], axis=0) if norm.any() else np.eye(1, width)

    cells = corpus.mapInArrow(_to_cells(pivots), "vec_id bigint, embedding array<double>, _cell int, _angle double, _norm double")
    cells = written(cells.withColumn("_row", F.monotonically_increasing_id()), "vector-cells")
    step = F.least(F.floor(F.col("_angle") / F.lit(np.pi) * STEPS), F.lit(STEPS - 1)).cast("int")
    # At most PIVOTS * STEPS rows: a cell's steps, inner ones first, are filled into parts; a step above a part's size is split.
    steps = cells.groupBy("_cell", step.alias("_step")).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(W.partitionBy("_cell").orderBy("_step").rowsBetween(W.unboundedPreceding, -1))
    steps = steps.select("_cell", "_step", F.floor(F.coalesce(before, F.lit(0)) / PART_ROWS).alias("_chunk"), F.ceil(F.col("_n") / PART_ROWS).alias("_splits"))
    split = F.when(F.col("_splits") > 1, F.pmod(F.xxhash64("_row"), F.col("_splits")) + 1).otherwise(F.lit(0))
    part = F.col("_cell").cast("bigint") * (1 << 56) + F.col("_chunk") * (1 << 28) + F.when(F.col("_splits") > 1, F.col("_step") * (1 << 20)).otherwise(0) + split
    placed = cells.withColumn("_step", step).join(F.broadcast(steps), ["_cell", "_step"]).withColumn("_part", part)
    placed = written(placed.select("_part", "_cell", "vec_id", "embedding", "_angle", "_norm"), "vector-parts")
    parts = written(placed.groupBy("_part", "_cell").agg(
        F.count("*").alias("_rows"), F.min("_angle").alias("_low"), F.max("_angle").alias("_high"),
        F.min("_norm").alias("_shortest"), F.max("_norm").alias("_longest")), "vector-part-ranges")

    located = written(vectors.mapInArrow(_to_pivots(pivots), "_query bigint, _angles array<double>, _length double"), "query-angles")
    angles = located.select("_query", "_length", F.posexplode("_angles").alias("_cell", "_at"))
    nearest = located.select("_query", "_length", (F.array_position("_angles", F.array_min("_angles")) - 1).cast("int").alias("_cell"), F.array_min("_angles").alias("_at"))
    home = written(nearest.join(parts, "_cell", "left").groupBy("_query").agg(
        F.max_by("_part", F.struct(F.coalesce(F.col("_rows") >= k, F.lit(False)), _bound(F.col("_at"), F.col("_length")), "_part")).alias("_part")), "query-home")
    first = written(_meet(home.filter(F.col("_part").isNotNull()), placed, vectors, k, width), "scores-home")
    floors = first.groupBy("_query").agg(F.count("*").alias("_found"), F.min("score").alias("_least"))
    floors = home.join(floors, "_query", "left").select("_query", F.col("_part").alias("_home"), F.when(F.col("_found") >= k, F.col("_least")).alias("_floor"))
    reached = angles.join(floors, "_query").join(parts, "_cell").filter(
        ~F.col("_part").eqNullSafe(F.col("_home")) & (F.col("_floor").isNull() | (_bound(F.col("_at"), F.col("_length")) >= F.col("_floor"))))
    pairs = written(reached.select("_query", "_part"), "query-parts")
    return first.unionByName(_meet(pairs, placed, vectors, k, width))


def top_k_many(corpus: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Best ``k`` corpus rows (``vec_id, embedding``) per query row (``query_id, embedding``): ``query_id, vec_id, score, rank``.

    Scores are inner products at nine decimals, ties go by vec_id, a whole number. Vectors need not have length one. Rows of
    the corpus without an id, and vectors that are null, empty or have a component that is null or not finite, take no
    part. Query rows that repeat an id, or have none, are queries of their own. Vectors are compared with those of their width.
    """
    numbered = written(_finite(queries, "query_id").withColumn("_query", F.monotonically_increasing_id()), "queries")
    whole = _finite(corpus.withColumn("vec_id", F.col("vec_id").cast("bigint")).filter(F.col("vec_id").isNotNull()), "vec_id")
    found = None
    for width in sorted(r["width"] for r in numbered.select(F.size("embedding").alias("width")).distinct().collect()):
        scores = _one_width(whole.filter(F.size("embedding") == width), numbered.filter(F.size("embedding") == width).select("_query", "embedding"), k, width)
        if scores is not None:
            found = scores if found is None else found.unionByName(scores)
    if found is None:
        return numbered.limit(0).select("query_id", F.lit(None).cast("bigint").alias("vec_id"), F.lit(0.0).alias("score"), F.lit(0).alias("rank"))
    ranked = W.partitionBy("_query").orderBy(F.col("score").desc(), F.col("vec_id").asc())
    best = found.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
    return best.join(numbered.select("_query", "query_id"), "_query").select("query_id", "vec_id", "score", "rank")
