"""Near copies by Jaccard similarity of five-word shingle sets: SimHash fingerprints joined by a binary trie and min-hash
bands find candidates, whole sets decide.

Two texts are near copies if their sets of five-word shingles have a Jaccard similarity of ``LEAST`` or more; groups are
the connected components. Texts with the same set are one node. Nodes meet in buckets: each has the SimHash fingerprint of its
set, and the groups that the trie join of ``simhash_dedup`` finds are buckets; at 0.8 fingerprints are about ten bits apart,
beyond its budget, so bands add the rest: each node has ``BANDS`` keys of ``ROWS`` min-hash values;
a pair at similarity s shares a key with probability 1 - (1 - s**ROWS)**BANDS: 0.99997 at 0.8, more above. All pairs of a
bucket whose sizes allow the similarity are decided, in two steps. First all pairs of a small bucket, and in a larger one a few
for each node (its next ``NEXT`` in the order of the following band's key, the first of its trie group): these join a large group
of close copies at no square. Then, in each larger bucket that is not one group yet, all pairs of nodes of different groups,
block by block of about ``BLOCK`` shingles, so that a bucket is shared by many tasks and none holds more than two blocks. A pair is
linked only if the sets themselves, read again, reach ``LEAST``: there are no false links, and the only loss is of pairs
that no bucket brings together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import bounded_batches, byte_texts, mapped, or_empty, stored
from millrace.llm.components import components
from millrace.llm.simhash_dedup import first_rows, near_links

WORDS = 5
SEED = 42
#: Similarity as a fraction of whole numbers, so that the border is exact.
LEAST = (4, 5)
BANDS, ROWS = 20, 4
#: Nodes of a bucket up to which all pairs are candidates at once; next nodes tried first in a larger one.
ALL_PAIRS, NEXT = 16, 2
#: Shingles of a block of a larger bucket, about; a longer set is a block of its own.
BLOCK = 1 << 17
#: Shingles taken through all min-hash functions at once.
PIECE = 1 << 12
_RANDOM = np.random.default_rng(SEED)
_FACTOR = _RANDOM.integers(0, 1 << 64, BANDS * ROWS, np.uint64)[:, None] | np.uint64(1)
_SHIFT = _RANDOM.integers(0, 1 << 64, BANDS * ROWS, np.uint64)[:, None]


def shingle_set(text: bytes) -> np.ndarray:
    """Sorted hashes of the distinct shingles; fewer than five words are one shingle, no word is none."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= WORDS:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[WORDS - 1:].tolist())], np.uint64))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """One key per band; none without a shingle."""
    if not len(hashes):
        return hashes
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for low in range(0, len(hashes), PIECE):
        np.minimum(least, (_FACTOR * hashes[None, low:low + PIECE] + _SHIFT).min(axis=1), out=least)
    raw = least.reshape(BANDS, ROWS)
    return np.array([xxhash.xxh64_intdigest(raw[b].tobytes(), b) for b in range(BANDS)], np.uint64)


def simprint(hashes: np.ndarray) -> int:
    """SimHash of a set: a bit is set if it is in more than half of the hashes."""
    set_bits = np.zeros(64, np.int64)
    for low in range(0, len(hashes), PIECE):
        set_bits += np.unpackbits(hashes[low:low + PIECE].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(hashes), bitorder="little").view("<u8")[0])


def _node(hashes: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(hashes.tobytes(), SEED)


def _signatures(marked: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, _row, fp, n, print, keys): fp is the digest of the set, n its size, print its SimHash."""
    source = marked.select(F.col(id_col).alias("id"), "_row", or_empty(text_col).alias("text"))

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set(t) for t in byte_texts(batch.column("text"))]
        return pa.record_batch([batch.column("id"), batch.column("_row"), pa.array(np.array([_node(s) for s in sets], np.uint64).view(np.int64)),
                                pa.array([len(s) for s in sets], pa.int32()), pa.array(np.array([simprint(s) for s in sets], np.uint64).view(np.int64)),
                                pa.array([band_keys(s).view(np.int64) for s in sets], pa.list_(pa.int64()))],
                               ["id", "_row", "fp", "n", "print", "keys"])

    kind = source.schema["id"].dataType.simpleString()
    return mapped(source, of, f"id {kind}, _row bigint, fp bigint, n int, print bigint, keys array<bigint>").withColumnRenamed("id", id_col)


def _sets(rows: DataFrame) -> DataFrame:
    """(fp, shingles) of rows (fp, text)."""
    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch([batch.column("fp"), pa.array([shingle_set(t).view(np.int64) for t in byte_texts(batch.column("text"))], pa.list_(pa.int64()))],
                               ["fp", "shingles"])

    return mapped(rows, of, "fp bigint, shingles array<bigint>")


def band_buckets(nodes: DataFrame) -> DataFrame:
    """(key, fp, n, size, after): nodes (fp, n, keys) that share a band with others, with the size of the bucket and the next nodes in it, all
    of a small one."""
    at = F.col("band")
    rows = nodes.select("fp", "n", "keys", F.posexplode("keys").alias("band", "key")).select(
        "key", "fp", "n", F.element_at("keys", (at + 1) % BANDS + 1).alias("then"))
    bucket = Window.partitionBy("key")
    order = bucket.orderBy("then", "fp")
    after = [F.struct(F.lit(j).alias("j"), F.lead("fp", j).over(order).alias("b"), F.lead("n", j).over(order).alias("nb")) for j in range(1, ALL_PAIRS)]
    return rows.withColumn("size", F.count("*").over(bucket)).select("key", "fp", "n", "size", F.array(*after).alias("after")).filter("size > 1")


def candidates(nodes: DataFrame, bands: DataFrame | None = None) -> DataFrame:
    """(a, b) pairs of ``nodes`` (fp, n, keys) that a band brings together and whose sizes allow the similarity; of larger buckets, some."""
    met = (band_buckets(nodes) if bands is None else bands).select("fp", "n", "size", F.explode("after").alias("x"))
    num, den = LEAST
    return (met.filter(F.col("x.b").isNotNull() & ((F.col("size") <= ALL_PAIRS) | (F.col("x.j") <= NEXT))
                       & (den * F.least("n", "x.nb") >= num * F.greatest("n", "x.nb")))
            .select(F.least("fp", "x.b").alias("a"), F.greatest("fp", "x.b").alias("b")).distinct())


def print_groups(nodes: DataFrame) -> DataFrame:
    """(key, fp, n) of ``nodes`` (fp, n, print): two nodes have the same key if chains of near fingerprints, as the trie join links them, join theirs."""
    prints = stored(nodes.select(F.col("print").alias("fp")).distinct(), "set-prints")
    roots = components(near_links(prints)).withColumnRenamed("node", "print")
    return nodes.join(roots, "print", "left").select(F.coalesce("root", "print").alias("key"), "fp", "n")


def print_candidates(nodes: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """(a, b) pairs of each of ``nodes`` (fp, n, print) with the first of its group whose sizes allow the similarity."""
    rows = print_groups(nodes) if groups is None else groups
    firsts = rows.groupBy("key").agg(F.min(F.struct("fp", "n")).alias("y")).select("key", "y.fp", "y.n").toDF("key", "first", "m")
    num, den = LEAST
    met = rows.join(firsts, "key").filter((F.col("fp") != F.col("first")) & (den * F.least("n", "m") >= num * F.greatest("n", "m")))
    return met.select(F.least("fp", "first").alias("a"), F.greatest("fp", "first").alias("b")).distinct()


def larger_buckets(bands: DataFrame, groups: DataFrame) -> DataFrame:
    """(key, fp, n) of the buckets of which :func:`candidates` and :func:`print_candidates` do not give all pairs."""
    wide = bands.filter(F.col("size") > ALL_PAIRS).select(F.lit("band").alias("kind"), "key", "fp", "n")
    chained = groups.join(groups.groupBy("key").agg(F.count("*").alias("size")).filter("size > 2").select("key"), "key")
    return wide.unionByName(chained.withColumn("kind", F.lit("print"))).select(F.xxhash64("kind", "key").alias("key"), "fp", "n")


def open_blocks(larger: DataFrame, links: DataFrame) -> DataFrame:
    """(key, p, q, side, fp, n, root): nodes of the buckets ``larger`` in which ``links`` leave several groups, dealt to the pairs of
    blocks that they are in. Blocks follow the size of the sets; pairs of blocks whose sizes do not allow the similarity are left out."""
    roots = components(links).withColumnRenamed("node", "fp")
    rows = stored(larger.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "larger-buckets")
    # Of buckets with the same nodes, one.
    kept = (rows.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("size"),
                                    F.bit_xor("fp").alias("x"), F.bit_xor(F.xxhash64("fp")).alias("y"))
            .filter("lo <> hi").groupBy("size", "x", "y").agg(F.min("key").alias("key")).select("key"))
    before = F.sum(F.col("n").cast("long")).over(Window.partitionBy("key").orderBy("n", "fp")) - F.col("n")
    placed = stored(rows.join(kept, "key").withColumn("block", F.floor(before / BLOCK)), "blocks")
    spans = placed.groupBy("key", "block").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    num, den = LEAST
    upper = spans.select("key", F.col("block").alias("q"), F.col("least").alias("above"))
    pairs = stored(spans.withColumnRenamed("block", "p").join(upper, "key")
                   .filter((F.col("p") <= F.col("q")) & (den * F.col("most") >= num * F.col("above"))).select("key", "p", "q"), "block-pairs")
    of = lambda side, met: placed.withColumnRenamed("block", side).join(met, ["key", side])
    both = of("p", pairs).withColumn("side", F.lit(0)).unionByName(of("q", pairs.filter("p < q")).withColumn("side", F.lit(1)))
    return both.select("key", "p", "q", "side", "fp", "n", "root")


def linked(sets: list[np.ndarray], roots: np.ndarray, cut: int) -> list[tuple[int, int]]:
    """Places of sorted sets of different groups (``roots``) that reach ``LEAST``, as many as join these groups: of each of the first
    ``cut`` sets with each from ``cut`` on, or all among each other if there are none."""
    labels, sizes, (num, den) = roots.copy(), np.array([len(x) for x in sets]), LEAST
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    places, found = np.arange(len(sets)), []
    for i in range(cut):
        others = (labels != labels[i]) & (places >= (cut if cut < len(sets) else i + 1))
        others &= den * np.minimum(sizes, sizes[i]) >= num * np.maximum(sizes, sizes[i])
        if not others.any():
            continue
        low, high = np.searchsorted(flat, sets[i]), np.searchsorted(flat, sets[i], side="right")
        n = high - low
        at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        shared = np.bincount(owner[at], minlength=len(sets))
        near = np.flatnonzero(others & (den * shared >= num * (sizes[i] + sizes - shared)))
        if len(near):
            joined, first = np.unique(labels[near], return_index=True)
            found += [(i, int(j)) for j in near[first]]
            labels[np.isin(labels, joined)] = labels[i]
    return found


def block_links(dealt: DataFrame) -> DataFrame:
    """(u, v) links of the rows of :func:`open_blocks` with their ``shingles``; a task holds one pair of blocks at a time."""
    spark = dealt.sparkSession
    bounded_batches(spark)

    def of(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows)
        fp, root, side = (table.column(c).to_numpy() for c in ("fp", "root", "side"))
        lists = table.column("shingles").combine_chunks()
        ends = lists.offsets.to_numpy()
        values = lists.values.to_numpy().view(np.uint64)
        found = linked([values[a:b] for a, b in zip(ends[:-1], ends[1:])], root, int((side == 0).sum()))
        return pa.record_batch([pa.array(fp[[x[k] for x in found]], pa.int64()) for k in (0, 1)], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(c).to_numpy() for c in ("key", "p", "q")], axis=1)
            starts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), len(key)]
            for low, high in zip(starts[:-1], starts[1:]):
                if held and tuple(key[low]) != last:
                    yield of(held)
                    held = []
                held.append(batch.slice(low, high - low))
                last = tuple(key[low])
        if held:
            yield of(held)

    return (dealt.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q", "side", "n", "fp")
            .select("key", "p", "q", "side", "fp", "root", "shingles").mapInArrow(run, "u bigint, v bigint"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies: of each group the row with the smallest id stays.

    Of rows with that id the one with the least hash over all columns stays; of equal rows, one. Null and empty texts
    are copies of each other. An empty table gives no rows.
    """
    marked = docs.withColumn("_row", F.xxhash64(*docs.columns))
    prints = stored(_signatures(marked, id_col, text_col), "signatures")

    def links(distinct: DataFrame) -> DataFrame:
        nodes = stored(prints.groupBy("fp").agg(F.min(F.struct("_row", "n", "print", "keys")).alias("x")).select("fp", "x.*"), "shingle-nodes")
        groups = stored(print_groups(nodes), "print-groups")
        bands = stored(band_buckets(nodes), "band-buckets")
        pairs = stored(print_candidates(nodes, groups).union(candidates(nodes, bands)).distinct(), "candidates")
        larger = stored(larger_buckets(bands, groups), "larger")
        wanted = pairs.select(F.col("a").alias("fp")).union(pairs.select(F.col("b").alias("fp"))).union(larger.select("fp")).distinct()
        texts = marked.select("_row", or_empty(text_col).alias("text")).join(nodes.select("fp", "_row").join(wanted, "fp"), "_row")
        sets = stored(_sets(texts.select("fp", "text")).dropDuplicates(["fp"]), "shingle-sets")
        both = (pairs.join(sets.select(F.col("fp").alias("a"), F.col("shingles").alias("sa")), "a")
                .join(sets.select(F.col("fp").alias("b"), F.col("shingles").alias("sb")), "b"))
        num, den = LEAST
        shared = F.size(F.array_intersect("sa", "sb"))
        found = stored(both.select("a", "b", shared.alias("shared"), (F.size("sa") + F.size("sb") - shared).alias("all"))
                       .filter(den * F.col("shared") >= num * F.col("all")).select(F.col("a").alias("u"), F.col("b").alias("v")), "first-links")
        if larger.isEmpty():
            return found
        return found.union(block_links(open_blocks(larger, found).join(sets, "fp")))

    return first_rows(marked, docs.columns, prints.select(id_col, "_row", "fp"), id_col, links)
