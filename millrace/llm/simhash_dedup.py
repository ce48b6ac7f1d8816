"""Near-duplicate groups by SimHash fingerprints, joined by a binary trie with itself.

Two fingerprints with at most ``MAX_BITS`` differing bits agree in at least one of ``MAX_BITS`` + 1 blocks of bits. For
each block the fingerprints are dealt out by its value; those that meet form a binary trie over the other bits. The
trie is joined with itself: pairs of nodes go down together, each branch apart adds a differing bit, and a pair above
the budget is dropped. A pair whose leaves are already known to be one group is dropped too, so that a large group of
close copies costs no square.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import byte_texts, mapped, or_empty, stored
from millrace.llm.components import components

WORDS = 4
SEED = 42
MAX_BITS = 4
#: Fingerprints of one partition, about.
PARTITION_ROWS = 400_000
#: A block value with more fingerprints than this is dealt out by pairs of trie nodes further down.
GROUP_ROWS = 200_000
#: Levels by which such a group is split, at most: each level doubles the nodes.
MAX_SPLIT = 8
#: Node pairs in hand at once; leaf pairs from which a node pair is compared directly.
FRONTIER, LEAF_PAIRS = 1 << 16, 64
#: Shingles hashed at once.
PIECE = 1 << 16


def fingerprint(text: bytes) -> int:
    """64 bits; a bit is set if it is in more than half of the hashes of all shingles, repeats included."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) <= WORDS:
        return xxhash.xxh64_intdigest(joined, SEED)
    digest, n = xxhash.xxh64_intdigest, len(words) - WORDS + 1
    starts, ends = starts[:n].tolist(), ends[WORDS - 1:].tolist()
    set_bits = np.zeros(64, np.int64)
    for low in range(0, n, PIECE):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[low:low + PIECE], ends[low:low + PIECE])], "<u8")
        set_bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, columns of ``keep``, fp): fp as signed long. Null and empty texts have fingerprint zero."""
    source = docs.select(F.col(id_col).alias("id"), or_empty(text_col).alias("text"), *[F.col(c).alias(f"keep_{c}") for c in keep])
    passed = ["id", *[f"keep_{c}" for c in keep]]

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([fingerprint(t) for t in byte_texts(batch.column("text"))], np.uint64).view(np.int64)
        return pa.record_batch([*[batch.column(c) for c in passed], pa.array(found)], [*passed, "fp"])

    own = ", ".join(f"{c} {source.schema[c].dataType.simpleString()}" for c in passed)
    return mapped(source, of, f"{own}, fp bigint").select(F.col("id").alias(id_col), *[F.col(f"keep_{c}").alias(c) for c in keep], "fp")


def block_starts(max_bits: int) -> list[int]:
    """First bit of each of max_bits + 1 blocks, from the top, and the end."""
    return [round(i * 64 / (max_bits + 1)) for i in range(max_bits + 2)]


def _rotated(fp: Column, bits: int) -> Column:
    return F.shiftleft(fp, bits).bitwiseOR(F.shiftrightunsigned(fp, 64 - bits)) if bits else fp


def _merge(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels after joining the groups of i and j; a label is the least place of its group."""
    while True:
        a, b = labels[i], labels[j]
        apart = a != b
        if not apart.any():
            return labels
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while True:
            shorter = labels[labels]
            if np.array_equal(shorter, labels):
                break
            labels = shorter


def _pairs(lo_a, hi_a, lo_b, hi_b):
    """All leaf pairs of node pairs; of a node with itself, each pair once."""
    wide = hi_b - lo_b
    n = (hi_a - lo_a) * wide
    of = np.repeat(np.arange(len(n)), n)
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    i, j = lo_a[of] + within // wide[of], lo_b[of] + within % wide[of]
    once = (lo_a[of] != lo_b[of]) | (i < j)
    return i[once], j[once]


def trie_join(values: np.ndarray, roots: np.ndarray, depth: int, max_bits: int) -> np.ndarray:
    """Group labels of ``values`` (unsigned, sorted inside each root) linked at ``max_bits`` or fewer differing bits.

    ``roots`` holds node pairs (lo_a, hi_a, lo_b, hi_b) whose leaves agree in the first ``depth`` bits or fewer.
    The budget is raised step by step, so that close groups are known before wide searches begin.
    """
    labels = np.arange(len(values))
    for budget in sorted({1, 2, max_bits} & set(range(max_bits + 1)) | {max_bits}):
        stack = [(depth, roots, np.zeros(len(roots), np.int64))]
        ones: dict[int, np.ndarray] = {}
        while stack:
            at, nodes, errors = stack.pop()
            if len(nodes) > FRONTIER:
                half = len(nodes) // 2
                stack += [(at, nodes[:half], errors[:half]), (at, nodes[half:], errors[half:])]
                continue
            change = np.concatenate([[0], np.cumsum(labels[1:] != labels[:-1])]) if len(labels) else labels
            lo_a, hi_a, lo_b, hi_b = nodes.T
            settled = ((change[hi_a - 1] == change[lo_a]) & (change[hi_b - 1] == change[lo_b]) & (labels[lo_a] == labels[lo_b])
                       if len(nodes) else np.zeros(0, bool))
            nodes, errors = nodes[~settled], errors[~settled]
            lo_a, hi_a, lo_b, hi_b = nodes.T
            small = (hi_a - lo_a) * (hi_b - lo_b) <= LEAF_PAIRS
            if at >= 64:
                small[:] = True
            if small.any():
                i, j = _pairs(lo_a[small], hi_a[small], lo_b[small], hi_b[small])
                near = np.bitwise_count(values[i] ^ values[j]) <= budget
                labels = _merge(labels, i[near], j[near])
                nodes, errors = nodes[~small], errors[~small]
                lo_a, hi_a, lo_b, hi_b = nodes.T
            if not len(nodes):
                continue
            if at not in ones:
                ones[at] = np.concatenate([[0], np.cumsum((values >> np.uint64(63 - at)) & np.uint64(1)).astype(np.int64)])
            c = ones[at]
            mid_a, mid_b = hi_a - (c[hi_a] - c[lo_a]), hi_b - (c[hi_b] - c[lo_b])
            itself = lo_a == lo_b
            below = np.concatenate([np.stack(x, axis=1) for x in (
                (lo_a, mid_a, lo_b, mid_b), (mid_a, hi_a, mid_b, hi_b), (lo_a, mid_a, mid_b, hi_b), (mid_a, hi_a, lo_b, mid_b))])
            more = np.concatenate([errors, errors, errors + 1, errors + 1])
            alive = (below[:, 1] > below[:, 0]) & (below[:, 3] > below[:, 2]) & (more <= budget)
            alive[3 * len(nodes):] &= ~itself
            stack.append((at + 1, below[alive], more[alive]))
    return labels


def _join_partition(batches: Iterator[pa.RecordBatch], starts: list[int], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Links (u, v) that hold the groups of one partition together: each fingerprint to the least place of its group."""
    rows = [b for b in batches if b.num_rows]
    if not rows:
        return
    table = pa.Table.from_batches(rows)
    block, value, p, q, side, turned = (table.column(c).to_numpy() for c in ("block", "value", "p", "q", "side", "turned"))
    turned = turned.view(np.uint64)
    for k in range(len(starts) - 1):
        rows = np.flatnonzero(block == k)
        if not len(rows):
            continue
        rows = rows[np.lexsort((turned[rows], side[rows], q[rows], p[rows], value[rows]))]
        key = np.stack([value[rows], p[rows], q[rows]], axis=1)
        first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)]))
        last = np.append(first[1:], len(rows))
        in_b = np.concatenate([[0], np.cumsum(side[rows])])
        cut = last - (in_b[last] - in_b[first])
        own = p[rows][first] == q[rows][first]
        roots = np.stack([first, np.where(own, last, cut), np.where(own, first, cut), last], axis=1)
        roots = roots[(roots[:, 1] > roots[:, 0]) & (roots[:, 3] > roots[:, 2])]
        bits = starts[k]
        values = turned[rows]
        labels = trie_join(values, roots, starts[k + 1] - starts[k], max_bits)
        linked = np.flatnonzero(labels != np.arange(len(labels)))
        if len(linked):
            back = (values >> np.uint64(bits)) | (values << np.uint64(64 - bits)) if bits else values
            yield pa.record_batch([pa.array(back[linked].view(np.int64)), pa.array(back[labels[linked]].view(np.int64))], ["u", "v"])


def near_links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(u, v) links whose components are those of all pairs with at most ``max_bits`` differing bits.

    ``distinct`` has one row per fingerprint (fp). Each goes to max_bits + 1 groups, one per block. A group above
    ``GROUP_ROWS`` is split into pairs of trie nodes (p, q): a fingerprint goes to the pairs of its node with every node
    that is near enough, so that a frequent block value is shared by many tasks.
    """
    spark = distinct.sparkSession
    starts = block_starts(max_bits)
    blocks = distinct.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("block"), F.shiftrightunsigned(_rotated(F.col("fp"), starts[k]), 64 - (starts[k + 1] - starts[k])).alias("value"),
                 _rotated(F.col("fp"), starts[k]).alias("turned"), F.lit(starts[k + 1] - starts[k]).alias("bits"))
        for k in range(max_bits + 1)])).alias("x")).select("x.*")
    n = distinct.count()
    hot = (stored(blocks.groupBy("block", "value").agg(F.count("*").alias("n")).filter(F.col("n") > GROUP_ROWS)
                  .select("block", "value", F.least(F.ceil(F.log2(F.col("n") / GROUP_ROWS)), F.lit(MAX_SPLIT)).cast("int").alias("split")), "hot-blocks")
           if n > GROUP_ROWS else None)
    plain = blocks if hot is None else blocks.join(hot, ["block", "value"], "left_anti")
    dealt = plain.select("block", "value", F.lit(0).alias("p"), F.lit(0).alias("q"), F.lit(0).alias("side"), "turned")
    if hot is not None:
        node = F.expr("CAST(shiftrightunsigned(shiftleft(turned, bits), 64 - split) AS INT)")
        near = F.expr(f"filter(sequence(0, shiftleft(1, split) - 1), x -> bit_count(x ^ node) <= {max_bits})")
        split = (blocks.join(hot, ["block", "value"]).withColumn("node", node).withColumn("other", F.explode(near))
                 .select("block", "value", F.least("node", "other").alias("p"), F.greatest("node", "other").alias("q"),
                         (F.col("node") > F.col("other")).cast("int").alias("side"), "turned"))
        dealt = dealt.unionByName(split)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n * (max_bits + 1) / PARTITION_ROWS))
    return (dealt.repartition(parts, "block", "value", "p", "q")
            .mapInArrow(lambda batches: _join_partition(batches, starts, max_bits), "u bigint, v bigint"))


def grouped(prints: DataFrame, id_col: str = "doc_id", links: Callable[[DataFrame], DataFrame] = near_links) -> DataFrame:
    """``prints`` (with fp) plus component_id, the smallest id of the group, and root, its least fingerprint.

    ``links`` makes the links (u, v) of the distinct fingerprints. A null id counts only if there is no other.
    """
    distinct = stored(prints.groupBy("fp").agg(F.min(id_col).alias("least")), "fingerprints")
    roots = components(links(distinct))
    of = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    # A written side, so that Spark can split a fingerprint of very many documents.
    named = stored(of.join(of.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id", "root"), "groups")
    return prints.join(named, "fp", "left")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id.

    Texts without a word have fingerprint zero and are linked like any other; texts of fewer than four words are one
    shingle. Repeated ids are rows of their own and meet in the group of the id's texts. An empty table gives no rows.
    """
    prints = stored(fingerprints(docs, id_col, text_col), "prints")
    return grouped(prints, id_col, lambda distinct: near_links(distinct, max_bits)).select(id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` without near copies: of each group the row with the smallest id stays.

    Of rows with that id the one with the least hash over all columns stays; of equal rows, one.
    """
    marked = docs.withColumn("_row", F.xxhash64(*docs.columns))
    prints = stored(fingerprints(marked, id_col, text_col, keep=("_row",)), "prints")
    return first_rows(marked, docs.columns, prints, id_col, lambda distinct: near_links(distinct, max_bits))


def first_rows(marked: DataFrame, columns: list[str], prints: DataFrame, id_col: str, links: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Of each group of ``prints`` (id, _row, fp) that ``links`` makes, the first row of ``marked`` (``columns``, _row), as in ``keep_one``."""
    firsts = grouped(prints, id_col, links).filter(F.col(id_col).eqNullSafe(F.col("component_id")))
    chosen = stored(firsts.groupBy("root").agg(F.min(F.struct("_row", id_col)).alias("least"))
                    .select(F.col("least").getField(id_col).alias(id_col), F.col("least._row").alias("_row"))
                    .join(prints.groupBy(F.col("_row").alias("_same")).agg(F.count("*").alias("_n")), F.col("_row") == F.col("_same"))
                    .select(id_col, "_row", "_n"), "kept-rows")
    key = [marked[id_col].eqNullSafe(chosen[id_col]), marked["_row"] == chosen["_row"]]
    single = marked.join(chosen.filter("_n = 1"), key, "left_semi").select(*columns)
    repeated = marked.join(chosen.filter("_n > 1"), key, "left_semi").dropDuplicates(["_row"]).select(*columns)
    return single.unionByName(repeated)
