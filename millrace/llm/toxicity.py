"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Terms are words, word beginnings of ``STEMS`` characters, and the latter once more as "seen at least n times" (``TIMES``):
of these, the ones that tell the labels apart, whose share of toxic examples differs from their share of the others by
more than ``LEAST_Z`` standard errors in the drawn examples, which leaves out terms too rare there to tell. Texts are TF-IDF
vectors of these terms, at length one; a text without any has one term that stands for all its words, so that an exact copy
of an example has cosine one with it. If the labels are drawn at different rates, document frequencies and votes count each
example by the inverse of its label's rate. The index holds the
examples' weights by term in blocks of examples with each block's maximum; a query adds the maxima to a bound per block,
visits blocks from the highest bound down and stops when no bound can reach its k-th best cosine, so the neighbours are
exact. Votes weigh with the cosine and a prior weight of ``PRIOR_WEIGHT`` pulls a score with little evidence to the
share of toxic examples; the neighbours are returned as evidence.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from dataclasses import dataclass
from itertools import filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import mapped, or_empty, stored

#: Labelled examples at most of each label: drawn by a hash of id and text.
MAX_EXAMPLES = 10_000
#: Longest text of an example in bytes; longer ones are not drawn.
MAX_EXAMPLE_BYTES = 1 << 20
LEAST_Z, LEAST_DOCUMENTS = 6.0, 5
NEIGHBOURS, PRIOR_WEIGHT = 15, 1.0
BLOCK = 64
#: Blocks that are scored before the bounds of the others are compared.
FIRST = 8
STEMS, TIMES = range(4, 9), (2, 4)
#: Words of which a task remembers the terms, and the copies of query vectors whose neighbours it remembers.
REMEMBERED, REMEMBERED_QUERIES = 200_000, 2_000
#: Postings of a term in more than one of this many examples are kept as a row with zeros; texts that are searched together.
FREQUENT, TOGETHER = 16, 128
_WORD = re.compile(r"\w+")


@dataclass
class Index:
    """Terms and weights, postings by term (rows) of examples and of blocks, and the examples' ids and labels."""

    vocabulary: dict[str, int]
    idf: np.ndarray
    rows: np.ndarray
    example: np.ndarray
    weight: np.ndarray
    block_rows: np.ndarray
    block: np.ndarray
    block_max: np.ndarray
    block_first: np.ndarray
    ids: list
    labels: np.ndarray
    prior: float
    #: Weight of a neighbour's vote by label.
    votes: tuple[float, float] = (1.0, 1.0)


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def terms_of(words: list[str]) -> Counter:
    """Counts of words (w), of word beginnings (^w) and of beginnings seen at least n times (^w/n)."""
    counts = Counter(words)
    stems = Counter()
    for word, n in counts.items():
        for size in STEMS:
            if len(word) < size:
                break
            stems[f"^{word[:size]}"] += n
    for stem, n in stems.items():
        counts[stem] = n
        for times in TIMES:
            if n >= times:
                counts[f"{stem}/{times}"] = 1
    return counts


def whole_term(words: list[str]) -> str:
    """The term of a text as a whole; no other term begins with this sign."""
    return "=" + hashlib.blake2b(" ".join(words).encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def _shorter(term: str) -> str:
    """The same kind of term with one letter less."""
    stem, slash, times = term.partition("/")
    return f"{stem[:-1]}{slash}{times}"


def _unit(counts: dict[int, int], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Terms in order and their weights, (1 + log tf) * idf, at length one."""
    terms = np.array(sorted(counts), np.int64)
    weights = np.array([1 + math.log(counts[t]) for t in terms.tolist()]) * idf[terms]
    norm = math.sqrt(float((weights * weights).sum()))
    return (terms, weights / norm) if norm else (terms[:0], weights[:0])


def vector(vocabulary: dict[str, int], idf: np.ndarray, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Unit vector of the known terms of these words; empty without one."""
    return _unit({t: n for term, n in terms_of(words).items() if (t := vocabulary.get(term)) is not None}, idf)


class Reader:
    """Vectors of texts. The terms of a word are looked up once; beyond ``REMEMBERED`` words the next text begins anew."""

    def __init__(self, vocabulary: dict[str, int], idf: np.ndarray):
        self.vocabulary, self.idf = vocabulary, idf
        self.telling: dict[str, tuple[int | None, list[str]]] = {}
        self.others: set[str] = set()
        # By beginning: the least number of occurrences and the term, None where the term counts occurrences.
        self.beginnings: dict[str, list[tuple[int | None, int]]] = {}
        for term, i in vocabulary.items():
            if term[0] == "^":
                stem, _, times = term.partition("/")
                self.beginnings.setdefault(stem[1:], []).append((int(times) if times else None, i))

    def _look_up(self, words) -> None:
        for word in words:
            own = self.vocabulary.get(word)
            stems = [word[:size] for size in STEMS if len(word) >= size and word[:size] in self.beginnings]
            if own is None and not stems:
                self.others.add(word)
            else:
                self.telling[word] = (own, stems)

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Vector of the telling terms; without any, of the one term of the whole text if the vocabulary has it."""
        words = words_of(text)
        if len(self.telling) + len(self.others) > REMEMBERED:
            self.telling.clear()
            self.others.clear()
        tf = Counter(filterfalse(self.others.__contains__, words))
        self._look_up([word for word in tf if word not in self.telling])
        counts: dict[int, int] = {}
        stems: dict[str, int] = {}
        for word, n in tf.items():
            own, beginnings = self.telling.get(word, (None, ()))
            if own is not None:
                counts[own] = n
            for stem in beginnings:
                stems[stem] = stems.get(stem, 0) + n
        for stem, n in stems.items():
            for least, term in self.beginnings[stem]:
                if least is None:
                    counts[term] = n
                elif n >= least:
                    counts[term] = 1
        terms, weights = _unit(counts, self.idf)
        whole = None if len(terms) or not words else self.vocabulary.get(whole_term(words))
        return (terms, weights) if whole is None else (np.array([whole], np.int64), np.ones(1))


def build_index(vocabulary: dict[str, int], idf: np.ndarray, ids: list, labels: np.ndarray, offsets: np.ndarray, terms: np.ndarray,
                weights: np.ndarray, prior: float, votes: tuple[float, float] = (1.0, 1.0)) -> Index:
    """Index of examples given by id, label and vector; vector i stands at offsets[i] to offsets[i + 1]."""
    terms, of = terms.astype(np.int64), np.repeat(np.arange(len(ids)), np.diff(offsets))
    order = np.lexsort((of, terms))
    terms, of, weights = terms[order], of[order], weights[order]
    blocks = max(1, -(-len(ids) // BLOCK))
    # Postings of a term are in order of examples, so those of a block stand together.
    key, first, place = np.unique(terms * blocks + of // BLOCK, return_index=True, return_inverse=True)
    most = np.zeros(len(key))
    np.maximum.at(most, place, weights)
    by_row = lambda rows: np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(vocabulary)))])
    return Index(vocabulary, idf, by_row(terms), of, weights, by_row(key // blocks), key % blocks, most, np.append(first, len(terms)),
                 ids, labels.astype(np.int64), prior, votes)


def _ranges(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All whole numbers from first to below last of each range: (number of the range, value)."""
    n = last - first
    of = np.repeat(np.arange(len(n)), n)
    return of, np.arange(len(of)) + np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n)


def nearest(index: Index, terms: np.ndarray, weights: np.ndarray, k: int) -> list[tuple[int, float]]:
    """(example, cosine) of the k nearest, best first; ties, equal to nine decimals, by place. Cosine zero is no neighbour.

    The ``FIRST`` blocks with the highest bounds give a k-th best cosine, then every block whose bound reaches it is scored.
    """
    if not len(terms):
        return []
    of, at = _ranges(index.block_rows[terms], index.block_rows[terms + 1])
    block = index.block[at]
    bound = np.floor(np.bincount(block, weights[of] * index.block_max[at]) * 1e9).astype(np.int64) + 2
    bound[bound <= 2] = 0
    left = bound > 0
    first = np.argpartition(-bound, FIRST - 1)[:FIRST] if len(bound) > FIRST else np.arange(len(bound))
    wanted = np.zeros(len(bound), bool)
    wanted[first] = left[first]
    places, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    while wanted.any():
        some = np.flatnonzero(wanted[block])
        part, posting = _ranges(index.block_first[at[some]], index.block_first[at[some] + 1])
        score = np.rint(np.bincount(index.example[posting], weights[of[some]][part] * index.weight[posting]) * 1e9).astype(np.int64)
        found = np.flatnonzero(score > 0)
        if len(found) > k:
            found = found[score[found] >= np.partition(score[found], len(found) - k)[len(found) - k]]
        places, scores = np.concatenate([places, found]), np.concatenate([scores, score[found]])
        best = np.lexsort((places, -scores))[:k]
        places, scores = places[best], scores[best]
        left &= ~wanted
        wanted = left & (bound >= (scores[k - 1] if len(places) == k else 0))
    return [(int(p), int(s) / 1e9) for p, s in zip(places, scores)]


class Searcher:
    """The search of ``nearest`` for many vectors together: a block is scored for all vectors whose bound reaches it.

    Within a block, postings of frequent terms are a matrix (terms by examples), those of the others stay lists.
    """

    def __init__(self, index: Index):
        self.index, self.blocks = index, max(1, -(-len(index.ids) // BLOCK))
        frequent = np.flatnonzero(np.diff(index.rows) * FREQUENT > len(index.ids))
        self.place = np.full(len(index.vocabulary), -1)
        self.place[frequent] = np.arange(len(frequent))
        self.dense = np.zeros((self.blocks, len(frequent), BLOCK))
        for i, term in enumerate(frequent.tolist()):
            part = slice(index.rows[term], index.rows[term + 1])
            self.dense[index.example[part] // BLOCK, i, index.example[part] % BLOCK] = index.weight[part]

    def __call__(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int) -> list[list[tuple[int, float]]]:
        return [found for low in range(0, len(vectors), TOGETHER) for found in self._search(vectors[low:low + TOGETHER], k)]

    def _search(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int) -> list[list[tuple[int, float]]]:
        ix, n, width = self.index, len(vectors), self.blocks * BLOCK
        query = np.repeat(np.arange(n), [len(t) for t, _ in vectors])
        terms, weights = (np.concatenate(x) for x in zip(*vectors))
        terms = terms.astype(np.int64)
        of, at = _ranges(ix.block_rows[terms], ix.block_rows[terms + 1])
        cell = query[of] * self.blocks + ix.block[at]
        bound = np.floor(np.bincount(cell, weights[of] * ix.block_max[at], n * self.blocks) * 1e9).astype(np.int64).reshape(n, -1) + 2
        bound[bound <= 2] = 0
        place = self.place[terms]
        frequent, listed = np.zeros((n, self.dense.shape[1])), (place < 0)[of]
        frequent[query[place >= 0], place[place >= 0]] = weights[place >= 0]

        scores, left = np.zeros(n * width), bound > 0
        by_query = scores.reshape(n, width)
        first = np.argpartition(-bound, FIRST - 1, axis=1)[:, :FIRST] if self.blocks > FIRST else np.tile(np.arange(self.blocks), (n, 1))
        wanted = np.zeros_like(left)
        np.put_along_axis(wanted, first, True, axis=1)
        wanted &= left
        for last in (False, True):
            some = np.flatnonzero(wanted.ravel()[cell] & listed)
            part, posting = _ranges(ix.block_first[at[some]], ix.block_first[at[some] + 1])
            rare = of[some][part]
            np.add.at(scores, query[rare] * width + ix.example[posting], weights[rare] * ix.weight[posting])
            for block in np.flatnonzero(wanted.any(axis=0)).tolist():
                asking = np.flatnonzero(wanted[:, block])
                by_query[asking, block * BLOCK:(block + 1) * BLOCK] += frequent[asking] @ self.dense[block]
            if last:
                break
            scored = np.take_along_axis(by_query.reshape(n, -1, BLOCK), first[:, :, None], axis=1).reshape(n, -1)
            size = scored.shape[1]
            least = np.rint(np.partition(scored, size - k, axis=1)[:, size - k] * 1e9).astype(np.int64) if size > k else np.zeros(n, np.int64)
            wanted = left & ~wanted & (bound >= least[:, None])
        least = np.maximum(least, 1)
        row, example = np.nonzero(by_query >= ((least - 0.75) * 1e-9)[:, None])
        whole = np.rint(by_query[row, example] * 1e9).astype(np.int64)
        reached = whole >= least[row]
        row, example, whole = row[reached], example[reached], whole[reached]
        order = np.lexsort((example, -whole, row))
        row, example, whole = row[order], example[order], whole[order]
        ends = np.searchsorted(row, np.arange(n + 1))
        return [[(int(p), int(c) / 1e9) for p, c in zip(example[low:min(low + k, high)], whole[low:min(low + k, high)])] for low, high in zip(ends[:-1], ends[1:])]


def vote(index: Index, found: list[tuple[int, float]]) -> float:
    """Share of toxic neighbours, weighted by cosine and the vote of their label; the prior counts as one of weight ``PRIOR_WEIGHT``."""
    total = sum(c * index.votes[index.labels[place]] for place, c in found)
    toxic = sum(c * index.votes[1] for place, c in found if index.labels[place] == 1)
    return (toxic + PRIOR_WEIGHT * index.prior) / (total + PRIOR_WEIGHT)


def learn(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_examples: int = MAX_EXAMPLES) -> Index:
    """Index of labelled rows (id, text, label 0 or 1); rows without a label are left out.

    At most about ``max_examples`` of each label are drawn, whole. Document frequencies are counted by Spark and, like votes,
    weighted by the number of rows that a drawn one stands for; the vote of the label drawn at the higher rate is one.
    """
    rows = _lots(labelled.select(F.col(id_col).alias("id"), or_empty(text_col).alias("text"), F.col(label_col).cast("int").alias("label"))
                 .filter(F.col("label").isin(0, 1)))
    n = _by_label(rows)
    return _index_of(stored(rows.filter(_is_drawn(n, max_examples)).drop("lot"), "examples") if n else None, n)


def learn_joined(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
                 max_examples: int = MAX_EXAMPLES) -> Index:
    """The index that :func:`learn` makes of ``docs`` joined with ``labels`` on the id; no text is shuffled for the join.

    Ids meet labels without texts. The labels of drawn rows, whose number ``max_examples`` bounds, are sent to all tasks and
    fetch the texts where they lie.
    """
    texts = _lots(docs.select(F.col(id_col).alias("id"), or_empty(text_col).alias("text")))
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).filter(F.col("label").isin(0, 1))
    lots = stored(texts.select("id", "lot").join(known, "id"), "labelled-ids")
    n = _by_label(lots)
    if not n:
        return _index_of(None, n)
    drawn = _is_drawn(n, max_examples)
    # Ids can repeat on both sides: each drawn pair of rows comes once, as in the join of all rows.
    wanted = stored(known.join(lots.filter(drawn).select("id", "label").distinct(), ["id", "label"], "left_semi"), "drawn-labels")
    return _index_of(stored(texts.join(F.broadcast(wanted), "id").filter(drawn).select("id", "text", "label"), "examples"), n)


def _lots(rows: DataFrame) -> DataFrame:
    """Rows short enough to be drawn, with the number that decides it."""
    return rows.filter(F.octet_length("text") <= MAX_EXAMPLE_BYTES).withColumn("lot", F.pmod(F.xxhash64("id", "text"), F.lit(1 << 20)))


def _by_label(rows: DataFrame) -> dict[int, int]:
    return {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}


def _is_drawn(n: dict[int, int], max_examples: int) -> Column:
    rate = F.create_map(*[x for label, count in n.items() for x in (F.lit(label), F.lit(int(min(1.0, max_examples / count) * (1 << 20))))])
    return F.col("lot") < F.element_at(rate, F.col("label"))


def _index_of(drawn: DataFrame | None, n: dict[int, int]) -> Index:
    """Index of the drawn examples (id, text, label); ``n`` has the number of all labelled rows by label."""
    if not n:
        nothing = np.zeros(0)
        return build_index({}, nothing, [], nothing, np.zeros(1, np.int64), nothing, nothing, 0.0)

    def distinct(batch: pa.RecordBatch) -> pa.RecordBatch:
        pairs = [(label, w) for label, text in zip(batch.column("label").to_pylist(), batch.column("text").to_pylist()) for w in terms_of(words_of(text))]
        return pa.record_batch([pa.array([p[0] for p in pairs], pa.int32()), pa.array([p[1] for p in pairs], pa.string())], ["label", "word"])

    size = _by_label(drawn)
    toxic_n, other_n = size.get(1, 0), size.get(0, 0)
    stands = {label: n.get(label, 0) / size[label] if size.get(label) else 1.0 for label in (0, 1)}
    total = n.get(1, 0) + n.get(0, 0)
    seen = (mapped(drawn.select("label", "text"), distinct, "label int, word string").groupBy("word")
            .agg(F.sum("label").alias("toxic"), (F.count("*") - F.sum("label")).alias("other")))
    share = (F.col("toxic") + F.col("other")) / F.lit(max(1, toxic_n + other_n))
    error = F.sqrt(share * (1 - share) * F.lit(1 / max(1, toxic_n) + 1 / max(1, other_n)) + 1e-12)
    gap = F.abs(F.col("toxic") / F.lit(max(1, toxic_n)) - F.col("other") / F.lit(max(1, other_n)))
    telling = seen.filter((F.col("toxic") + F.col("other") >= LEAST_DOCUMENTS) & (gap / error > LEAST_Z)).orderBy("word").toArrow().to_pylist()
    seen_in = {r["word"]: (r["toxic"], r["other"]) for r in telling}
    # A longer beginning that is in the very same examples says nothing new.
    telling = [r for r in telling if not (r["word"].startswith("^") and seen_in.get(_shorter(r["word"])) == seen_in[r["word"]])]
    vocabulary = {r["word"]: i for i, r in enumerate(telling)}
    idf = np.array([math.log((1 + total) / (1 + stands[1] * r["toxic"] + stands[0] * r["other"])) + 1 for r in telling])

    def vectors(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, read = batch.column("text").to_pylist(), Reader(vocabulary, idf)
        found = [read(t) for t in texts]
        whole = [whole_term(words) if not len(v) and (words := words_of(t)) else None for t, (v, _) in zip(texts, found)]
        return pa.record_batch([batch.column("id"), batch.column("label"), pa.array([t.tolist() for t, _ in found], pa.list_(pa.int32())),
                                pa.array([w.tolist() for _, w in found], pa.list_(pa.float64())), pa.array(whole, pa.string())],
                               ["id", "label", "terms", "weights", "whole"])

    kind = drawn.schema["id"].dataType.simpleString()
    reduced = (mapped(drawn, vectors, f"id {kind}, label int, terms array<int>, weights array<double>, whole string")
               .filter((F.size("terms") > 0) | F.col("whole").isNotNull()).orderBy("id", "terms", "label").toArrow())
    rows_whole = reduced["whole"].to_pylist()
    for term in rows_whole:
        if term is not None:
            vocabulary.setdefault(term, len(vocabulary))
    idf = np.append(idf, np.ones(len(vocabulary) - len(idf)))
    reduced = reduced.set_column(2, "terms", pa.array([t if w is None else [vocabulary[w]] for t, w in zip(reduced["terms"].to_pylist(), rows_whole)], pa.list_(pa.int32())))
    reduced = reduced.set_column(3, "weights", pa.array([x if w is None else [1.0] for x, w in zip(reduced["weights"].to_pylist(), rows_whole)], pa.list_(pa.float64())))
    offsets = np.concatenate([[0], np.cumsum(pc.list_value_length(reduced["terms"]).to_numpy())]).astype(np.int64)
    flat = lambda c, t: pc.list_flatten(reduced[c]).to_numpy().astype(t)
    # All rows count for the share of toxic ones, whatever was drawn.
    return build_index(vocabulary, idf, reduced["id"].to_pylist(), reduced["label"].to_numpy(), offsets, flat("terms", np.int64),
                       flat("weights", np.float64), n.get(1, 0) / sum(n.values()), tuple(stands[x] / min(stands[y] for y in size) for x in (0, 1)))


def score_texts(docs: DataFrame, index: Index, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), k: int = NEIGHBOURS) -> DataFrame:
    """One row per input row: id, columns of ``keep``, score, predicted, evidence (array of (example, cosine, label)).

    A text without a telling term that is no copy of an example, an empty or a null one has the score of the prior and no evidence. Without labelled
    rows every score is 0. Rows with a null or repeated id are answered one by one. Texts are read whole.
    """
    holder = docs.sparkSession.sparkContext.broadcast(index)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *[F.col(c).alias(f"keep_{c}") for c in keep])
    passed = ["id", *[f"keep_{c}" for c in keep]]
    own = ", ".join(f"{c} {source.schema[c].dataType.simpleString()}" for c in passed)
    state: dict = {}

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        ix = holder.value
        if not state:
            state.update(read=Reader(ix.vocabulary, ix.idf), search=Searcher(ix), known={}, ids=pa.array([str(x) for x in ix.ids], pa.string()))
        known, scores, places, cosines, ends = state["known"], [], [], [], [0]
        if len(known) > REMEMBERED_QUERIES:
            known.clear()
        vectors = [state["read"](text or "") for text in batch.column("text").to_pylist()]
        keys = [(terms.tobytes(), weights.tobytes()) for terms, weights in vectors]
        new = {key: v for key, v in zip(keys, vectors) if key not in known}
        for key, found in zip(new, state["search"](list(new.values()), k)):
            known[key] = vote(ix, found), [p for p, _ in found], [c for _, c in found]
        for key in keys:
            score, at, cosine = known[key]
            scores.append(score)
            places += at
            cosines += cosine
            ends.append(len(places))
        where = np.array(places, np.int64)
        evidence = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
            [state["ids"].take(pa.array(where)), pa.array(cosines, pa.float64()), pa.array(ix.labels[where].astype(np.int32))], ["example", "cosine", "label"]))
        predicted = [int(s >= 0.5) for s in scores]
        return pa.record_batch([*[batch.column(c) for c in passed], pa.array(scores, pa.float64()), pa.array(predicted, pa.int32()), evidence],
                               [*passed, "score", "predicted", "evidence"])

    out = mapped(source, of, f"{own}, score double, predicted int, evidence array<struct<example:string,cosine:double,label:int>>")
    return out.select(F.col("id").alias(id_col), *[F.col(f"keep_{c}").alias(c) for c in keep], "score", "predicted", "evidence")
