"""Hard negatives by inner product: a cover tree over norm-augmented candidates, searched best-first inside score windows.

Components become whole numbers, so scores are exact. Candidates are dealt out to the nearest of a bounded number of pivots; a
pivot with many rows has several cells of about ``CELL_ROWS`` rows, so a third of all rows on one spot is many cells. Each cell
is a cover tree: points get one more component that brings all of them to the same length, each node knows the covering
radius of its members, and every level has a smaller radius than the one above. On that sphere the angle between a query and a
node's centre and the angle of its radius bound the inner products of all its members from both sides.

A block of queries goes down together: the node with the highest bound comes first, a query goes on only into nodes that lie
inside one of its windows and can still reach the worst of the rows it keeps, and the members of a leaf are verified in exact
arithmetic for the queries that arrive there. Positives are found first (in an anchor's own cell,
then in the pivots that its worst positive does not rule out); their scores give the windows of the negatives.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import bounded_batches, stored

#: Rows of a cell, about; anchors that meet a cell in one task, about.
CELL_ROWS, TASK_ANCHORS = 4096, 2048
#: Pivots at most, and bytes of their vectors at most.
MAX_PIVOTS, PIVOT_BYTES = 256, 4 << 20
#: A level's covering radius shrinks to this share, or the node has ``FAN_OUT`` children; leaves have ``LEAF`` members or fewer.
SHRINK, FAN_OUT, LEAF = 0.8, 16, 256
#: Relative slack of a bound against rounding.
SLACK = 1e-9
#: Scores up to here are exact in doubles, up to the second one in 64-bit whole numbers.
EXACT_DOUBLE, EXACT_LONG = 2.0 ** 53, 2.0 ** 63
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1
TREE = ("pivot int, chunk int, nos array<bigint>, ids array<bigint>, labels array<bigint>, vectors array<double>, size int, "
        "centre array<int>, radius array<double>, first array<int>, last array<int>, child array<int>, children array<int>")
QUERY = "no bigint, anchor_id bigint, label bigint, v array<double>, own_pivot int, own_chunk int, floor bigint, windows array<struct<positive:bigint,lo:bigint,hi:bigint>>"
FOUND = "no bigint, anchor_id bigint, slot int, other_no bigint, other_id bigint, score bigint"


def matrix(vectors: pa.Array) -> np.ndarray:
    """Lists of doubles as rows, shorter ones filled with zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    sizes = np.diff(vectors.offsets.to_numpy()) if len(vectors) else np.zeros(0, int)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(sizes) and (sizes == sizes[0]).all():
        return flat.reshape(len(sizes), -1)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))))
    out[np.arange(out.shape[1])[None, :] < sizes[:, None]] = flat
    return out


def as_lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(rows) if rows else np.zeros(0), kind))


def widen(x: np.ndarray, width: int) -> np.ndarray:
    return x if x.shape[1] >= width else np.pad(x, ((0, 0), (0, width - x.shape[1])))


def augmented(x: np.ndarray) -> tuple[np.ndarray, float]:
    """Points with one more component that makes them all as long as the longest, and that length."""
    square = np.einsum("ij,ij->i", x, x)
    most = float(square.max(initial=0.0))
    return np.concatenate([x, np.sqrt(np.maximum(most - square, 0.0))[:, None]], axis=1), float(np.sqrt(most))


def _split(points: np.ndarray, members: np.ndarray, distance: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Centres and the centre of each member: the farthest member becomes the next centre until the radius has shrunk enough."""
    centres, of, least = [0], np.zeros(len(members), np.int64), distance.copy()
    wanted = SHRINK * float(least.max())
    while len(centres) < FAN_OUT and (far := int(least.argmax())) not in centres and least[far] > wanted:
        away = np.sqrt(np.maximum(((points[members] - points[members[far]]) ** 2).sum(axis=1), 0.0))
        nearer = away < least
        of[nearer], least[nearer] = len(centres), away[nearer]
        centres.append(far)
    return centres, of


def build_tree(x: np.ndarray) -> dict[str, np.ndarray]:
    """Cover tree as arrays: ``order`` of the rows, and per node its centre (a place in that order), radius, range of members and of children."""
    points, _ = augmented(x)
    order = np.arange(len(x))
    centre, radius, first, last, child, children = [], [], [], [], [], []
    queue = [(0, len(x))]
    for lo, hi in queue:  # grows while nodes are split; children of a node stand together
        members = order[lo:hi]
        away = np.sqrt(np.maximum(((points[members] - points[members[0]]) ** 2).sum(axis=1), 0.0))
        r = float(away.max())
        centre.append(lo), radius.append(r), first.append(lo), last.append(hi)
        child.append(len(queue)), children.append(0)
        if hi - lo <= LEAF or r == 0.0:
            continue
        centres, of = _split(points, members, away)
        if len(centres) < 2:
            continue
        # A child's centre is its first member.
        lead = np.ones(len(members), np.int64)
        lead[centres] = 0
        order[lo:hi] = members[np.lexsort((lead, of))]
        ends = lo + np.concatenate([[0], np.cumsum(np.bincount(of, minlength=len(centres)))])
        queue += list(zip(ends[:-1].tolist(), ends[1:].tolist()))
        children[-1] = len(centres)
    ints = {k: np.array(v, np.int32) for k, v in (("centre", centre), ("first", first), ("last", last), ("child", child), ("children", children))}
    return {"order": order, "radius": np.array(radius), **ints}


def bounds(queries: np.ndarray, centres: np.ndarray, radius: np.ndarray, length: float) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each query with any member of each node; ``centres`` are not augmented."""
    size = np.sqrt(np.einsum("ij,ij->i", queries, queries))[:, None]
    most = size * length
    cosine = np.divide(queries @ centres.T, most, out=np.zeros((len(queries), len(centres))), where=most > 0)
    angle, reach = np.arccos(np.clip(cosine, -1, 1)), 2 * np.arcsin(np.clip(radius / (2 * length) if length else radius * 0, 0, 1))[None, :]
    slack = SLACK * most + 1e-6 * most + 1e-6  # arccos loses half the digits near one
    return most * np.cos(np.minimum(angle + reach, np.pi)) - slack, most * np.cos(np.maximum(angle - reach, 0)) + slack


def scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact."""
    most = np.sqrt(np.einsum("ij,ij->i", x, x).max(initial=0.0) * np.einsum("ij,ij->i", q, q).max(initial=0.0))
    if most < EXACT_DOUBLE:
        return (q @ x.T).astype(np.int64)
    if most >= EXACT_LONG:
        raise ValueError("scores of these vectors do not fit into a long")
    return q.astype(np.int64) @ x.astype(np.int64).T


class Cell:
    """A stored cover tree."""

    def __init__(self, row: dict[str, pa.Array]):
        take = lambda c, kind: row[c].values.to_numpy(zero_copy_only=False).astype(kind)
        self.nos, self.labels, self.radius = take("nos", np.int64), take("labels", np.int64), take("radius", np.float64)
        known = row["ids"].values.is_valid().to_numpy(zero_copy_only=False)
        self.ids = row["ids"].values
        # Place of each row in the order of ties: by id, a null one last.
        self.tie = np.empty(len(known), np.int64)
        self.tie[np.lexsort((self.nos, self.ids.fill_null(0).to_numpy(zero_copy_only=False), ~known))] = np.arange(len(known))
        self.x = take("vectors", np.float64).reshape(len(self.nos), -1)
        self.centre, self.first, self.last, self.child, self.children = (take(c, np.int64) for c in ("centre", "first", "last", "child", "children"))
        self.length = float(np.sqrt(np.einsum("ij,ij->i", self.x, self.x).max(initial=0.0)))

    def search(self, q: np.ndarray, own: np.ndarray, label: np.ndarray, same: bool, of: np.ndarray, lo: np.ndarray, hi: np.ndarray,
               k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places (-1: none) and scores of the best ``k`` rows of the same or of another label, by window.

        Window w belongs to query ``of[w]`` and takes scores from ``lo[w]`` to ``hi[w]``.
        """
        width = max(q.shape[1], self.x.shape[1])
        q, x = widen(q, width), widen(self.x, width)
        low, high = bounds(q, x[self.centre], self.radius, self.length)
        place, score, least = np.full((len(of), k), -1), np.full((len(of), k), LOWEST), lo.copy()
        heap = [(-np.inf, 0, np.arange(len(of)))]
        while heap:
            _, node, open_ = heapq.heappop(heap)
            open_ = open_[(high[of[open_], node] >= least[open_]) & (low[of[open_], node] <= hi[open_])]
            if not len(open_):
                continue
            if self.children[node]:
                for c in range(self.child[node], self.child[node] + self.children[node]):
                    heapq.heappush(heap, (-float(high[of[open_], c].max()), c, open_))
                continue
            rows = np.arange(self.first[node], self.last[node])
            asked, back = np.unique(of[open_], return_inverse=True)
            found = scores(q[asked], x[rows])
            allowed = ((label[asked][:, None] == self.labels[rows][None, :]) == same) & (own[asked][:, None] != self.nos[rows][None, :])
            found, fit = found[back], allowed[back]
            fit &= (found >= least[open_][:, None]) & (found <= hi[open_][:, None])
            many = np.flatnonzero(fit.sum(axis=1) > k)
            if len(many):  # rows below a window's k-th best here are of no use
                kth = np.partition(np.where(fit[many], found[many], LOWEST), len(rows) - k, axis=1)[:, len(rows) - k]
                fit[many] &= found[many] >= kth[:, None]
            w, at = np.nonzero(fit)
            if not len(w):
                continue
            touched = np.unique(w)
            old = open_[touched]
            kept_w, kept_at = np.nonzero(place[old] >= 0)
            every_w = np.concatenate([touched[kept_w], w])
            every_place = np.concatenate([place[old][kept_w, kept_at], rows[at]])
            every_score = np.concatenate([score[old][kept_w, kept_at], found[w, at]])
            order = np.lexsort((self.tie[every_place], -every_score, every_w))
            every_w = every_w[order]
            start = np.flatnonzero(np.concatenate([[True], every_w[1:] != every_w[:-1]]))
            nth = np.arange(len(order)) - np.repeat(start, np.diff(np.append(start, len(order))))
            best = nth < k
            into = open_[every_w[best]]
            place[into, nth[best]], score[into, nth[best]] = every_place[order][best], every_score[order][best]
            full = open_[touched][place[open_[touched], k - 1] >= 0]
            least[full] = np.maximum(least[full], score[full, k - 1])
        return place, score


def whole_vectors(rows: DataFrame, id_col: str, vector_col: str, label: Column, scale: int) -> DataFrame:
    """(no, vec_id, label, v): rows that take part, with whole-number components. Written, so the row numbers stay."""
    number = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf"))
    return stored(rows.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col(vector_col).alias("v"))
                  .filter(F.col("label").isNotNull() & F.col("v").isNotNull() & F.forall("v", number))
                  .select(F.monotonically_increasing_id().alias("no"), "vec_id", "label",
                          F.transform("v", lambda x: F.floor(x.cast("double") * scale).cast("double")).alias("v")), "whole-vectors")


def nearest_pivot(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``vectors`` plus pivot, the nearest one, and its distance."""
    bounded_batches(vectors.sparkSession)
    holder = vectors.sparkSession.sparkContext.broadcast(pivots)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column("v"))
            width = max(x.shape[1], holder.value.shape[1])
            x, p = widen(x, width), widen(holder.value, width)
            square = np.einsum("ij,ij->i", x, x)[:, None] + np.einsum("ij,ij->i", p, p)[None, :] - 2 * (x @ p.T)
            pivot = square.argmin(axis=1)
            yield pa.record_batch([*batch.columns, pa.array(pivot.astype(np.int32)), pa.array(np.sqrt(((x - p[pivot]) ** 2).sum(axis=1)))],
                                  [*batch.schema.names, "pivot", "away"])

    return vectors.mapInArrow(of, "no bigint, vec_id bigint, label bigint, v array<double>, pivot int, away double")


def _grow(table: pa.Table) -> pa.Table:
    """The cover tree of one cell as a row."""
    x = matrix(table["v"])
    tree = build_tree(x)
    order = tree.pop("order")
    one = lambda values, kind: as_lists([np.asarray(values)], kind)
    ids = table["vec_id"].combine_chunks().take(pa.array(order))
    return pa.table({"pivot": table["pivot"].slice(0, 1).combine_chunks(), "chunk": table["chunk"].slice(0, 1).combine_chunks(),
                     "nos": one(table["no"].to_numpy()[order], pa.int64()), "ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                     "labels": one(table["label"].to_numpy()[order], pa.int64()), "vectors": one(x[order].ravel(), pa.float64()),
                     "size": pa.array([x.shape[1]], pa.int32()), "centre": one(tree["centre"], pa.int32()), "radius": one(tree["radius"], pa.float64()),
                     **{c: one(tree[c], pa.int32()) for c in ("first", "last", "child", "children")}})


class Trees:
    """Stored cover trees of all rows, and what routes a query to them: the bounded pivots with their radii and cells."""

    def __init__(self, vectors: DataFrame):
        """``vectors``: (no, vec_id, label, v), written."""
        n, width = vectors.agg(F.count("*"), F.max(F.size("v"))).first()
        most = max(1, min(MAX_PIVOTS, PIVOT_BYTES // (8 * max(1, width or 1)), -(-n // CELL_ROWS)))
        drawn = vectors.orderBy(F.xxhash64("no"), "no").limit(most).select("v").toArrow()
        self.pivots = matrix(drawn["v"])
        self.dealt = stored(nearest_pivot(vectors, self.pivots), "dealt-vectors")
        sizes = self.dealt.groupBy("pivot").agg(F.count("*").alias("n"), F.max("away").alias("radius"), F.max(F.aggregate(
            "v", F.lit(0.0), lambda s, x: s + x * x)).alias("square")).orderBy("pivot").collect()
        self.of = np.array([r["pivot"] for r in sizes], np.int64)
        self.radius = np.array([r["radius"] for r in sizes], np.float64)
        self.cells = np.array([-(-r["n"] // CELL_ROWS) for r in sizes], np.int64)
        counts = F.create_map(*[F.lit(int(x)) for r in zip(self.of, self.cells) for x in r]) if len(self.of) else F.create_map(F.lit(0), F.lit(1))
        self.placed = self.dealt.withColumn("chunk", F.pmod(F.xxhash64("no"), F.element_at(counts, F.col("pivot"))).cast("int"))
        self.table = stored(self.placed.groupBy("pivot", "chunk").applyInArrow(_grow, TREE), "cover-trees")

    def routed(self, queries: DataFrame, home: bool) -> DataFrame:
        """``queries`` once for each cell to ask: only their own one, or those whose pivot's bounds meet floor and windows."""
        if home:
            return queries.select("*", F.col("own_pivot").alias("pivot"), F.col("own_chunk").alias("chunk"))
        bounded_batches(queries.sparkSession)
        holder = queries.sparkSession.sparkContext.broadcast((self.pivots[self.of] if len(self.of) else self.pivots, self.of, self.radius, self.cells))

        def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pivots, numbers, radius, cells = holder.value
            for batch in batches:
                q = matrix(batch.column("v"))
                width = max(q.shape[1], pivots.shape[1])
                q, p = widen(q, width), widen(pivots, width)
                near, reach = q @ p.T, np.sqrt(np.einsum("ij,ij->i", q, q))[:, None] * radius[None, :]
                high, low = near + reach * (1 + SLACK) + 1e-3, near - reach * (1 + SLACK) - 1e-3
                asked = high >= batch.column("floor").to_numpy()[:, None]
                windows = batch.column("windows").to_pylist()
                for i, some in enumerate(windows):
                    if some:
                        asked[i] &= np.any([(high[i] >= w["lo"]) & (low[i] <= w["hi"]) for w in some], axis=0)
                row, at = np.nonzero(asked)
                times = cells[at]
                row, at = np.repeat(row, times), np.repeat(at, times)
                chunk = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
                for a in range(0, len(row), 1000):
                    part = slice(a, a + 1000)
                    out = batch.take(pa.array(row[part]))
                    yield pa.record_batch([*out.columns, pa.array(numbers[at[part]].astype(np.int32)), pa.array(chunk[part].astype(np.int32))],
                                          [*out.schema.names, "pivot", "chunk"])

        return queries.mapInArrow(of, f"{QUERY}, pivot int, chunk int")

    def search(self, queries: DataFrame, n_queries: int, same: bool, k: int, home: bool = False) -> DataFrame:
        """``FOUND``: per query and window (slot; 0 without windows) up to ``k`` best rows of each cell that is asked.

        A task has one cell and about ``TASK_ANCHORS`` queries.
        """
        parts = max(1, -(-n_queries // TASK_ANCHORS))
        routed = self.routed(queries, home).withColumn("part", F.pmod(F.xxhash64("no"), F.lit(parts)).cast("int"))
        trees = self.table.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

        def of(tree: pa.Table, asked: pa.Table) -> pa.Table:
            if not tree.num_rows or not asked.num_rows:
                return pa.table({n: pa.array([], pa.int32() if n == "slot" else pa.int64()) for n in ("no", "anchor_id", "slot", "other_no", "other_id", "score")})
            cell = Cell({c: tree[c].combine_chunks() for c in tree.column_names if pa.types.is_list(tree[c].type)})
            windows = asked["windows"].to_pylist()
            # Without windows a query takes all scores from its floor.
            each = [[(w["lo"], w["hi"]) for w in some or ()] or [(floor, HIGHEST)] for some, floor in zip(windows, asked["floor"].to_pylist())]
            of = np.repeat(np.arange(len(each)), [len(e) for e in each])
            slot = np.concatenate([np.arange(len(e)) for e in each])
            lo, hi = (np.array([w[i] for e in each for w in e], np.int64) for i in (0, 1))
            place, score = cell.search(matrix(asked["v"]), asked["no"].to_numpy(), asked["label"].to_numpy(), same, of, lo, hi, k)
            w, nth = np.nonzero(place >= 0)
            at = place[w, nth]
            return pa.table({"no": asked["no"].take(pa.array(of[w])), "anchor_id": asked["anchor_id"].take(pa.array(of[w])), "slot": pa.array(slot[w].astype(np.int32)),
                             "other_no": pa.array(cell.nos[at]), "other_id": cell.ids.take(pa.array(at)), "score": pa.array(score[w, nth])})

        return (trees.groupBy("pivot", "chunk", "part").cogroup(routed.groupBy("pivot", "chunk", "part")).applyInArrow(of, FOUND))


def _first(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each query and window over all cells, with rank from 1."""
    order = Window.partitionBy("no", "slot").orderBy(F.desc("score"), F.asc_nulls_last("other_id"), "other_no")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(rows: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label: Column | None = None, scale: int = 256,
         positives: int = 5, negatives: int = 5, least: tuple[int, int] = (4, 5)) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), one row per hard negative.

    Components count as floor(scale * x). ``anchor`` is a condition on ``vec_id``, the id; an anchor's positives are its best other rows of
    the same label. For each, the best rows of other labels are returned whose score lies between ``least`` (a fraction) of the
    positive's score and that score. Higher scores come first, ties by smaller id, a null id last.

    Rows with a null label, a null vector or a null, infinite or undefined component take no part. Vectors of different length are filled
    with zeros; an empty one has score 0 with all. Repeated ids and equal rows are rows of their own. A positive with a negative score
    has no negatives. Scores that do not fit into a long raise. An empty table gives no rows.
    """
    vectors = whole_vectors(rows, id_col, vector_col, F.col("label") if label is None else label, scale)
    trees = Trees(vectors)
    none = F.array().cast("array<struct<positive:bigint,lo:bigint,hi:bigint>>")
    anchors = stored(trees.placed.filter(anchor).select("no", F.col("vec_id").alias("anchor_id"), "label", "v", F.col("pivot").alias("own_pivot"),
                                                        F.col("chunk").alias("own_chunk"), F.lit(LOWEST).cast("bigint").alias("floor"), none.alias("windows")), "anchors")
    n = anchors.count()
    # The worst positive of an anchor's own cell is a floor for those of all cells.
    home = stored(_first(trees.search(anchors, n, True, positives, home=True), positives), "home-positives")
    floors = home.filter(F.col("rank") == positives).select("no", F.col("score").alias("reached"))
    asked = anchors.join(floors, "no", "left").withColumn("floor", F.coalesce("reached", "floor")).drop("reached")
    near = stored(_first(trees.search(asked, n, True, positives), positives), "positives")
    num, den = least
    lo = F.ceil(F.col("score").cast("decimal(38,0)") * num / den).cast("bigint")
    windows = near.filter("score >= 0").groupBy("no").agg(F.sort_array(F.collect_list(F.struct(
        F.col("rank").alias("nth"), F.col("other_id").alias("positive"), lo.alias("lo"), F.col("score").alias("hi")))).alias("found"))
    asked = anchors.drop("windows").join(windows, "no").select(
        *[c for c in anchors.columns if c != "windows"], F.transform("found", lambda x: F.struct(x["positive"].alias("positive"), x["lo"].alias("lo"), x["hi"].alias("hi"))).alias("windows"))
    asked = stored(asked, "windows")
    best = _first(trees.search(asked, n, False, negatives), negatives)
    window = F.element_at("windows", F.col("slot") + 1)
    return (best.join(asked.select("no", "windows"), "no")
            .select("anchor_id", window["positive"].alias("positive_id"), "rank", F.col("other_id").alias("negative_id"),
                    window["hi"].alias("positive_score"), F.col("score").alias("negative_score")))
