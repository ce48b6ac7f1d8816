"""Language model scoring by a hashed maximum-entropy model over n-gram and skip features with a class-factored softmax.

Word counts cover the whole training corpus. The ``OWN`` most frequent training words are symbols of their own, every other word
falls by checksum into one of ``SHARED`` symbols, inside which its probability is its smoothed share of that symbol's count, so any
text has a probability. A symbol is a class and a member of it. The history gives ``FEATURES`` hashed features: a bias, the last
word, the last two, the second last and the third last. Class scores are the sum of the features' rows of one table, member
scores the sum of the rows of (feature, class) of another, for the first ``MEMBER_FEATURES`` of them; both tables have a fixed number of rows, so what a task holds is bounded.

Training passes once over all training documents in ``ROUNDS`` disjoint parts. In a round every task starts from the same tables,
makes gradient steps (one learning rate per row, falling with its gradients) over its documents and sends the change of each row
and how often it was touched; changes are added up in a tree of shuffles, weighted by touches, and become the next round's tables.

Scoring reads texts in batches of sparse features. Words outside the bounded list of frequent ones are joined with the table
of all counts, so no vocabulary passes through the driver and no frequent word is a join key.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import BATCH_BYTES, bounded_batches, by_bytes, byte_texts, mapped, or_empty, stored

#: Symbols: classes times members; ``OWN`` of them stand for one word each, the last ``SHARED`` for all others.
CLASSES, MEMBERS = 32, 32
SHARED = 64
OWN = CLASSES * MEMBERS - SHARED
#: Rows of the two weight tables (powers of two).
CLASS_ROWS, MEMBER_ROWS = 1 << 14, 1 << 15
FEATURES, MEMBER_FEATURES = 4, 3
#: Frequent words, and bytes of one, that every task knows; this bounds what is broadcast.
FREQUENT, FREQUENT_BYTES = 100_000, 64
ROUNDS, STEP, MINIBATCH = 4, 0.1, 4096
#: Rows of a run that is summed on its own.
LONG_RUN = 8
#: Tokens that a task of a round trains on, at least about: the tables it sends back are small against its texts.
TASK_TOKENS = 4_000_000
#: Rows of a table sent as one block; tasks whose blocks are added up at once.
BLOCK_ROWS, FAN_IN = 2048, 32
#: Smoothing of counts.
ALPHA = 0.1
#: The end of a text as a word; no other word is empty.
END = b""
#: Ids: rare words get their checksum plus this; two starts precede a text.
RARE, START = 1 << 20, (1 << 20) - 1
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


class Ids(dict):
    """Frequent words to their rank; any other word to ``RARE`` plus its checksum."""

    def __missing__(self, word: bytes) -> int:
        return RARE + crc32(word)


@dataclass
class Model:
    """Counts of frequent words in order of rank, what the shared symbols sum up to, totals, and the weight tables."""

    words: list[bytes]
    counts: np.ndarray
    shared_total: np.ndarray
    shared_kinds: np.ndarray
    tokens: int
    kinds: int
    #: Weights and summed squares of classes and members.
    tables: list[list[np.ndarray]]

    def prepare(self) -> Model:
        """Look-up arrays, made in each process."""
        self.ids = Ids((w, i) for i, w in enumerate(self.words))
        rank = np.arange(len(self.words))
        own = (rank < OWN) & (self.counts > 0)
        self.symbol = np.where(own, rank, OWN + np.array([crc32(w) % SHARED for w in self.words], np.int64) if len(rank) else rank).astype(np.int64)
        self.log_count = np.log10(self.counts + ALPHA)
        self.shared_log = np.log10(self.shared_total + ALPHA * (self.shared_kinds + 1))
        return self


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def token_ids(ids: Ids, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[list[bytes]]]:
    """Ids of all texts on end, each after two starts and before its end; where tokens are; tokens per text; words per text."""
    words = [words_of(t) for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    out = np.full(int(sizes.sum()) + 3 * len(words), START, np.int64)
    real = np.ones(len(out), bool)
    at = 0
    for some in words:
        real[at:at + 2] = False
        out[at + 2:at + 2 + len(some)] = np.fromiter(map(ids.__getitem__, some), np.int64, len(some))
        at += len(some) + 3
        out[at - 1] = ids[END]
    return out, np.flatnonzero(real), sizes + 1, words


def symbols_of(model: Model, ids: np.ndarray) -> np.ndarray:
    rare = ids >= RARE
    return np.where(rare, OWN + (ids - RARE) % SHARED, model.symbol[np.where(rare, 0, ids)] if len(model.symbol) else 0)


def features(ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hashed features (unsigned) of the tokens at the places ``at``, one row per kind."""
    one, two = (ids[at - k].astype(np.uint64) for k in (1, 2))
    raw = np.stack([np.zeros(len(at), np.uint64), one * _MIX[0] + _MIX[1], (two * _MIX[1]) ^ (one * _MIX[2]), two * _MIX[3] + _MIX[2]])
    raw ^= raw >> np.uint64(32)
    raw *= _MIX[0]
    return raw ^ (raw >> np.uint64(29))


def class_rows(feature: np.ndarray) -> np.ndarray:
    return (feature & np.uint64(CLASS_ROWS - 1)).astype(np.int32)


def member_rows(feature: np.ndarray, cls: np.ndarray) -> np.ndarray:
    mixed = (feature[:MEMBER_FEATURES] ^ ((cls.astype(np.uint64) + np.uint64(1)) * _MIX[2])[None, :]) * _MIX[3]
    return (mixed >> np.uint64(64 - MEMBER_ROWS.bit_length() + 1)).astype(np.int32)


def softmax(table: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Probabilities from the summed rows of a table, one column of ``rows`` per token."""
    total = np.take(table, rows[0], axis=0)
    for more in rows[1:]:
        total += np.take(table, more, axis=0)
    # Weights are clipped far below where exp overflows, so no maximum is taken out.
    np.exp(np.clip(total, -60, 60, out=total), out=total)
    total /= (total @ np.ones(total.shape[1], np.float32))[:, None]
    return total


def step(weights: np.ndarray, squares: np.ndarray, touched: np.ndarray, rows: np.ndarray, slope: np.ndarray) -> None:
    """One gradient step; ``squares`` sums up the squared gradients that slow a row down. The first feature is one row for all."""
    flat = rows[1:].ravel()
    order = np.argsort(flat.astype(np.uint16) if len(weights) <= 1 << 16 else flat, kind="stable")
    ranked = np.take(flat, order)
    start = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    size = np.diff(np.append(start, len(flat)))
    longest = np.argsort(np.minimum(size, 255).astype(np.uint8), kind="stable")[::-1]
    start, size = np.take(start, longest), np.take(size, longest)
    summed, into = _sums(np.take(slope, order % rows.shape[1], axis=0), start, size), np.take(ranked, start)
    for i, gradient, times in ((rows[0, :1], slope.sum(axis=0, keepdims=True), rows.shape[1]), (into, summed, size)):
        squares[i] += np.einsum("ij,ij->i", gradient, gradient) / gradient.shape[1]
        gradient *= (-STEP / np.sqrt(np.take(squares, i) + 1e-6))[:, None]
        weights[i] += gradient
        touched[i] += times


def _sums(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sums of ``size`` rows from each start, longest runs first: long runs one by one, the n-th rows of all short runs together."""
    out = np.take(values, start, axis=0)
    alone = int((size > LONG_RUN).sum())
    for run in range(alone):
        out[run] = values[start[run]:start[run] + size[run]].sum(axis=0)
    for nth in range(1, LONG_RUN):
        upto = int((size > nth).sum())
        if upto <= alone:
            break
        out[alone:upto] += np.take(values, start[alone:upto] + nth, axis=0)
    return out


def train_on(model: Model, tables: list[list[np.ndarray]], texts: list[bytes]) -> int:
    """Gradient steps over the tokens of some texts, in place; ``tables`` are (weights, squares, touched) of classes and members."""
    ids, at, _, _ = token_ids(model.ids, texts)
    for low in range(0, len(at), MINIBATCH):
        some = at[low:low + MINIBATCH]
        feature, symbol = features(ids, some), symbols_of(model, ids[some])
        each, cls = np.arange(len(some)), symbol // MEMBERS
        for table, rows, target in ((tables[0], class_rows(feature), cls), (tables[1], member_rows(feature, cls), symbol % MEMBERS)):
            slope = softmax(table[0], rows)
            slope[each, target] -= 1
            step(*table, rows, slope)
    return len(at)


def symbol_logs(model: Model, ids: np.ndarray, at: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """log10 of each token's symbol given its history."""
    out = np.empty(len(at))
    for low in range(0, len(at), MINIBATCH):
        some, mine = at[low:low + MINIBATCH], symbol[low:low + MINIBATCH]
        feature, each = features(ids, some), np.arange(len(some))
        by_class = softmax(model.tables[0][0], class_rows(feature))[each, mine // MEMBERS]
        by_member = softmax(model.tables[1][0], member_rows(feature, mine // MEMBERS))[each, mine % MEMBERS]
        out[low:low + MINIBATCH] = np.log10(np.maximum(by_class.astype(np.float64) * by_member, 1e-300))
    return out


def word_counts(docs: DataFrame, text_col: str, learned: Column) -> DataFrame:
    """(word, n, n_all): occurrences in the rows of ``learned`` and in all rows; the end of a text is the empty word. Written."""
    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for text, train in zip(byte_texts(batch.column("text")), batch.column("train").to_pylist()):
            counts[train].update(words_of(text))
            counts[train][END] += 1
        words = [*counts[1], *counts[0]]
        n = [*counts[1].values(), *[0] * len(counts[0])]
        return pa.record_batch([pa.array(words, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array([*counts[1].values(), *counts[0].values()], pa.int64())],
                               ["word", "n", "n_all"])

    source = docs.select(or_empty(text_col).alias("text"), F.coalesce(learned, F.lit(False)).alias("train"))
    return stored(mapped(source, of, "word string, n bigint, n_all bigint").groupBy("word").agg(F.sum("n").alias("n"), F.sum("n_all").alias("n_all")), "word-counts")


def _added(blocks: DataFrame, tasks: int) -> pa.Table:
    """Blocks of all tasks summed up, ``FAN_IN`` at a time, in the order of tasks; the tables' size bounds the result."""
    schema = "task int, kind int, block int, n bigint, part binary"

    def of(some: pa.Table) -> pa.Table:
        some = some.sort_by("task")
        total = np.zeros(len(some["part"][0].as_py()) // 4, np.float64)
        for part in some["part"]:
            total += np.frombuffer(part.as_py(), np.float32)
        return pa.table({"task": some["group"].slice(0, 1), "kind": some["kind"].slice(0, 1), "block": some["block"].slice(0, 1),
                         "n": pa.array([sum(some["n"].to_pylist())], pa.int64()), "part": pa.array([total.astype(np.float32).tobytes()], pa.binary())})

    while True:
        blocks = blocks.withColumn("group", F.expr(f"task div {FAN_IN}").cast("int")).groupBy("kind", "block", "group").applyInArrow(of, schema)
        tasks = -(-tasks // FAN_IN)
        if tasks <= 1:
            return blocks.toArrow()


def _round(part: DataFrame, model: Model) -> None:
    """One round of training over ``part`` (text): the model's tables become the average of what the tasks made of them."""
    spark = part.sparkSession
    bounded_batches(spark)
    holder = spark.sparkContext.broadcast(model)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = holder.value.prepare()
        tables = [[w.copy(), q.copy(), np.zeros(len(w), np.float32)] for w, q in mine.tables]
        n = 0
        for batch in batches:
            for some in by_bytes(batch, "text", BATCH_BYTES):
                n += train_on(mine, tables, byte_texts(some.column("text")))
        if not n:
            return
        for kind, ((weights, squares, touched), (before, slowed)) in enumerate(zip(tables, mine.tables)):
            sent = np.concatenate([(weights - before) * touched[:, None], ((squares - slowed) * touched)[:, None], touched[:, None]], axis=1).astype(np.float32)
            for block in range(-(-len(sent) // BLOCK_ROWS)):
                yield pa.record_batch([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([kind], pa.int32()), pa.array([block], pa.int32()),
                                       pa.array([n], pa.int64()), pa.array([sent[block * BLOCK_ROWS:(block + 1) * BLOCK_ROWS].tobytes()], pa.binary())],
                                      ["task", "kind", "block", "n", "part"])

    tasks = max(1, min(part.rdd.getNumPartitions(), -(-model.tokens // (ROUNDS * TASK_TOKENS))))
    part = part.coalesce(tasks)
    summed = _added(part.mapInArrow(of, "task int, kind int, block int, n bigint, part binary"), tasks)
    for kind, block, raw in zip(*(summed[c].to_pylist() for c in ("kind", "block", "part"))):
        weights, squares = model.tables[kind]
        change = np.frombuffer(raw, np.float32).reshape(-1, weights.shape[1] + 2)
        change, rows = change / np.maximum(change[:, -1:], 1), slice(block * BLOCK_ROWS, (block + 1) * BLOCK_ROWS)
        weights[rows] += change[:, :-2]
        squares[rows] += change[:, -2]
    holder.destroy()


def empty_tables() -> list[list[np.ndarray]]:
    return [[np.zeros((rows, wide), np.float32), np.zeros(rows, np.float32)] for rows, wide in ((CLASS_ROWS, CLASSES), (MEMBER_ROWS, MEMBERS))]


def learn(docs: DataFrame, learned: Column, text_col: str = "text") -> tuple[Model, DataFrame]:
    """Model from all rows of ``learned`` (a condition on ``docs``), and the written table of word counts.

    The driver holds the ``FREQUENT`` words and the weight tables, both of fixed size.
    """
    counts = word_counts(docs, text_col, learned)
    total = counts.agg(F.sum("n").alias("n"), F.count(F.when(F.col("n") > 0, 1)).alias("kinds")).first()
    end = F.lit(END.decode())
    short = counts.filter((F.octet_length("word") <= FREQUENT_BYTES) & (F.col("word") != end)).orderBy(F.desc("n_all"), "word").limit(FREQUENT)
    frequent = {w.encode(): n for w, n in zip(*(c.to_pylist() for c in short.union(counts.filter(F.col("word") == end)).select("word", "n").toArrow().columns))}
    frequent.setdefault(END, 0)  # an empty table
    words = sorted(frequent, key=lambda w: (-frequent[w], w))
    n = np.array([frequent[w] for w in words], np.int64)
    own = [w.decode() for w, c in zip(words[:OWN], n[:OWN]) if c > 0]
    shared = (counts.filter((F.col("n") > 0) & ~F.col("word").isin(own)).groupBy((F.crc32("word") % SHARED).alias("shared"))
              .agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).collect())
    totals, kinds = np.zeros(SHARED), np.zeros(SHARED)
    for r in shared:
        totals[r["shared"]], kinds[r["shared"]] = r["n"], r["kinds"]
    model = Model(words, n, totals, kinds, total["n"] or 0, total["kinds"], empty_tables())
    train = docs.filter(F.coalesce(learned, F.lit(False))).select(or_empty(text_col).alias("text"))
    for i in range(ROUNDS):
        _round(train.filter(F.pmod(F.xxhash64("text"), F.lit(ROUNDS)) == i), model)
    return model, counts


def score_texts(docs: DataFrame, model: Model, counts: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: id, columns of ``keep``, n_tokens, n_known, train_tokens, base_score and score, the log10 of the text's probability.

    A text is its words, with A-Z in lower case, and one end. ``base_score`` is the smoothed unigram score. Null and empty texts are one
    end. Repeated rows and null ids are scored one by one. With nothing learned every symbol is equally likely. Texts are read whole.
    """
    spark = docs.sparkSession
    holder = spark.sparkContext.broadcast(model)
    source = docs.select(F.col(id_col).alias("id"), or_empty(text_col).alias("text"), *[F.col(c).alias(f"keep_{c}") for c in keep])
    passed = ["id", *[f"keep_{c}" for c in keep]]
    own = ", ".join(f"{c} {source.schema[c].dataType.simpleString()}" for c in passed)

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        now = holder.value
        if not hasattr(now, "ids"):
            now.prepare()
        ids, at, sizes, words = token_ids(now.ids, byte_texts(batch.column("text")))
        mine = ids[at]
        symbol, known = symbols_of(now, mine), mine < RARE
        shared = symbol >= OWN
        counted = np.where(known, now.log_count[np.where(known, mine, 0)], 0.0)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        add = lambda x: np.add.reduceat(x, starts) if len(starts) else np.zeros(0)
        predicted = symbol_logs(now, ids, at, symbol) - np.where(shared, now.shared_log[np.where(shared, symbol - OWN, 0)], 0.0)
        # Rare words, counted by text.
        text = np.repeat(np.arange(len(sizes)), sizes)
        place = np.flatnonzero(~known)
        pair = Counter(zip(text[place].tolist(), [words[t][j] for t, j in zip(text[place].tolist(), (place - starts[text[place]]).tolist())]))
        ends = np.searchsorted(np.fromiter((t for t, _ in pair), np.int64, len(pair)), np.arange(len(sizes) + 1))
        rare = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
            [pa.array([w for _, w in pair], pa.binary()).cast(pa.string()), pa.array(list(pair.values()), pa.int64())], ["word", "k"]))
        # Words that no row was counted with are rare; a frequent one may still be unknown to the training rows.
        seen = known & (now.counts[np.where(known, mine, 0)] > 0)
        return pa.record_batch([*[batch.column(c) for c in passed], pa.array(sizes), pa.array(add(seen.astype(np.int64)), pa.int64()), pa.array(add(counted), pa.float64()),
                                pa.array(add(np.where(shared, counted, 0.0) + predicted), pa.float64()), rare],
                               [*passed, "n_tokens", "n_known", "base", "model", "rare"])

    out = stored(mapped(source, of, f"{own}, n_tokens bigint, n_known bigint, base double, model double, rare array<struct<word:string,k:bigint>>")
                 .withColumn("no", F.monotonically_increasing_id()), "scored-texts")
    wanted = out.select("no", F.explode("rare").alias("x")).select("no", "x.word", "x.k")
    c = F.coalesce("n", F.lit(0))
    rest = (wanted.join(counts.select("word", "n"), "word", "left").groupBy("no")
            .agg(F.sum(F.when(c > 0, F.col("k")).otherwise(0)).alias("rare_known"), F.sum(F.col("k") * F.log10(c + ALPHA)).alias("rare_log")))
    zero = lambda name: F.coalesce(name, F.lit(0))
    base = F.col("base") + zero("rare_log") - F.col("n_tokens") * F.lit(math.log10(model.tokens + ALPHA * (model.kinds + 1)))
    return (out.drop("rare").join(rest, "no", "left")
            .select(F.col("id").alias(id_col), *[F.col(f"keep_{c}").alias(c) for c in keep], "n_tokens", (F.col("n_known") + zero("rare_known")).alias("n_known"),
                    F.lit(model.tokens).cast("long").alias("train_tokens"), base.alias("base_score"), (F.col("model") + zero("rare_log")).alias("score")))
