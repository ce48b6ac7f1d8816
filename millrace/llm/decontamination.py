"""Benchmark decontamination: BM25 retrieval of test items for every training passage, then exact verification.

Items are cut into entries of at most ``ENTRY_WORDS`` words; an inverted index holds each entry's BM25 impacts as shares
of the entry's score against itself. Every passage of ``PASSAGE_WORDS`` words, one each ``STRIDE`` words, is a query, so
every stretch of an entry's length lies whole in a passage. All entries with a score of ``MIN_SCORE`` or more are retrieved:
an entry's frequent terms together stay below the score, so it can only get there with some of its other, essential
terms. Their postings are gathered first by block of entries with the block's maximal impacts; blocks whose bound stays
below the score are skipped, then entries likewise, and the rest are scored in full. All passages of a batch go through
each step together.

The item of a retrieved entry is verified whole by its five-word shingles: ``MIN_OVERLAP`` of all, and ``MIN_PART`` of those
of the question and of those of the answer, must stand in a window around the passage: for an item of up to ``ENTRY_WORDS``
words the passage itself, for a longer one neighbouring passages, so that every stretch of the item's length lies whole in
a window. The answer begins after a question mark or "answer:"; without one, in the middle.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import mapped, or_empty, stored

K1, B = 1.2, 0.75
ENTRY_WORDS, PASSAGE_WORDS, STRIDE = 64, 128, 64
SHINGLE = 5
MIN_SCORE, MIN_OVERLAP, MIN_PART = 0.5, 0.8, 0.5
#: Share of an entry's own score that its frequent terms may hold.
REST = 0.25
#: Entries of one block, and items of one index; more items are searched index after index.
BLOCK, INDEX_ITEMS = 32, 20_000
_WORD = re.compile(r"\w+")
_ANSWER = re.compile(r"\?|\banswer\s*:", re.I)


@dataclass
class Index:
    """Postings in rows by term: essential ones by block (with maxima) and by entry, all terms of each entry and its item.

    By item: shingles of question and answer, and the number of passages in a window.
    """

    items: list
    vocabulary: dict[str, int]
    block_rows: np.ndarray
    block_of: np.ndarray
    block_max: np.ndarray
    block_need: np.ndarray
    entry_rows: np.ndarray
    entry_of: np.ndarray
    entry_impact: np.ndarray
    entry_need: np.ndarray
    full: list[dict[int, float]]
    item_of: list[int]
    question: list[frozenset]
    answer: list[frozenset]
    spans: list[int]
    block_size: int = BLOCK


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def shingles(words: list[str]) -> list[tuple]:
    """All five-word shingles in order; of fewer words, the whole sequence."""
    return [tuple(words[i:i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))] if words else []


def answer_place(text: str, words: list[str]) -> int:
    """Place of the answer's first word; the middle if a mark leaves nothing before or after it."""
    mark = _ANSWER.search(text)
    answer = len(words_of(text[:mark.end()])) if mark else len(words) // 2
    return answer if 0 < answer < len(words) else len(words) // 2


def entries_of(text: str) -> list[tuple[list[str], int]]:
    """(words, place of the answer) of each entry; neighbouring entries share four words, the last reaches back to full length."""
    words = words_of(text)
    answer = answer_place(text, words)
    step = ENTRY_WORDS - SHINGLE + 1
    out = []
    for low in range(0, max(1, len(words) - SHINGLE + 1), step):
        low = max(0, min(low, len(words) - ENTRY_WORDS))
        part = words[low:low + ENTRY_WORDS]
        inside = answer - low
        out.append((part, inside if 0 < inside < len(part) else len(part) // 2))
    return out if words else []


def _by_row(rows: np.ndarray, n: int) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))])


def build_index(items: list[tuple], frequency: dict[str, int], n_entries: int, mean_words: float) -> Index:
    """Index of (item id, text) pairs with the document frequencies of all entries of the benchmark."""
    owners, vocabulary, full, item_of, question, answer, spans = [], {}, [], [], [], [], []
    terms, of, impacts, needs = [], [], [], []
    for item, text in items:
        whole = words_of(text or "")
        if not whole:
            continue
        cuts, cut = shingles(whole), answer_place(text, whole)
        question.append(frozenset(cuts[:cut]))
        answer.append(frozenset(cuts[cut:]))
        spans.append(-(-len(whole) // ENTRY_WORDS))
        for words, _ in entries_of(text):
            norm = K1 * (1 - B + B * len(words) / mean_words)
            score = {w: math.log(1 + (n_entries - frequency[w] + 0.5) / (frequency[w] + 0.5)) * tf * (K1 + 1) / (tf + norm) for w, tf in Counter(words).items()}
            own = sum(score.values())
            shares = {vocabulary.setdefault(w, len(vocabulary)): s / own for w, s in score.items()}
            rest = 0.0
            for term, share in sorted(shares.items(), key=lambda x: (x[1], x[0])):
                if rest + share <= REST:
                    rest += share
                else:
                    terms.append(term)
                    of.append(len(owners))
                    impacts.append(share)
            needs.append(MIN_SCORE - rest)
            owners.append(item)
            full.append(shares)
            item_of.append(len(spans) - 1)
    terms, of, impacts, needs = np.array(terms, np.int64), np.array(of, np.int64), np.array(impacts), np.array(needs)
    order = np.lexsort((of, terms))
    terms, of, impacts = terms[order], of[order], impacts[order]
    blocks = max(1, -(-len(owners) // BLOCK))
    pairs, place = np.unique(terms * blocks + of // BLOCK, return_inverse=True)
    most = np.zeros(len(pairs))
    np.maximum.at(most, place, impacts)
    block_need = np.full(blocks, np.inf)
    np.minimum.at(block_need, np.arange(len(owners)) // BLOCK, needs)
    n = len(vocabulary)
    return Index(owners, vocabulary, _by_row(pairs // blocks, n), pairs % blocks, most, block_need, _by_row(terms, n), of, impacts, needs, full, item_of, question, answer, spans, BLOCK)


def _spread(rows: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each wanted term its postings: (number of the wanted term, place of the posting)."""
    n = rows[wanted + 1] - rows[wanted]
    of = np.repeat(np.arange(len(wanted)), n)
    return of, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + rows[wanted][of]


def candidates(index: Index, passage: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(passage, entry) pairs that essential terms let reach the score, from distinct (passage, term) pairs."""
    blocks, slack = len(index.block_need), 1e-9
    of, at = _spread(index.block_rows, term)
    key, place = np.unique(passage[of] * blocks + index.block_of[at], return_inverse=True)
    bound = np.bincount(place, weights=index.block_max[at], minlength=len(key))
    key = key[bound >= index.block_need[key % blocks] - slack]
    if not len(key):
        return key, key
    # Only passages with a block left, then only postings in these blocks.
    some = np.isin(passage, key // blocks)
    passage, term = passage[some], term[some]
    of, at = _spread(index.entry_rows, term)
    entry = index.entry_of[at]
    alive = np.isin(passage[of] * blocks + entry // index.block_size, key)
    of, at, entry = of[alive], at[alive], entry[alive]
    width = len(index.items)
    pair, place = np.unique(passage[of] * width + entry, return_inverse=True)
    bound = np.bincount(place, weights=index.entry_impact[at], minlength=len(pair))
    pair = pair[bound >= index.entry_need[pair % width] - slack]
    return pair // width, pair % width


def reached(index: Index, ids: np.ndarray, passage: int, entry: int) -> float | None:
    """Score of the passage for the entry if it reaches ``MIN_SCORE``; else None."""
    low = passage * STRIDE
    present = set(ids[low:low + PASSAGE_WORDS].tolist())
    score = sum(s for t, s in index.full[entry].items() if t in present)
    return score if score >= MIN_SCORE - 1e-9 else None


def holds(index: Index, words: list[str], first: int, item: int) -> bool:
    """Whether enough of the item's shingles, of all and of each part, stand in its window from passage ``first`` on."""
    question, answer = index.question[item], index.answer[item]
    whole = question | answer
    low = first * STRIDE
    window = words[low:low + (index.spans[item] - 1) * STRIDE + PASSAGE_WORDS]
    size = len(next(iter(whole)))
    here = {tuple(window[i:i + size]) for i in range(len(window) - size + 1)}
    return len(whole & here) >= MIN_OVERLAP * len(whole) and all(len(part & here) >= MIN_PART * len(part) for part in (question, answer))


def search(index: Index, texts: list[str]) -> list[dict]:
    """For each text {item: best score of an entry of it in a passage of a window that holds the item}."""
    out: list[dict] = [{} for _ in texts]
    get = index.vocabulary.get
    essential = index.entry_rows[1:] > index.entry_rows[:-1]
    all_words, all_ids, firsts, passages, terms, base = [], [], [], [], [], 0
    for text in texts:
        words = words_of(text) if text else []
        ids = np.array([get(w, -1) for w in words], np.int64)
        all_words.append(words)
        all_ids.append(ids)
        firsts.append(base)
        at = np.flatnonzero(ids >= 0)
        at = at[essential[ids[at]]]
        last = max(0, -(-len(words) // STRIDE) - 1)
        for shift in (0, 1):
            inside = at if not shift else at[at >= STRIDE]
            passages.append(base + inside // STRIDE - shift)
            terms.append(ids[inside])
        base += last + 1
    n = len(index.vocabulary)
    pairs = np.unique(np.concatenate(passages) * n + np.concatenate(terms)) if passages and n else np.zeros(0, np.int64)
    if not len(pairs):
        return out
    starts = np.array(firsts)
    held: dict[tuple[int, int, int], bool] = {}
    for passage, entry in zip(*candidates(index, pairs // n, pairs % n)):
        text = int(np.searchsorted(starts, passage, side="right")) - 1
        place, own = int(passage - starts[text]), index.item_of[entry]
        item = index.items[entry]
        score = reached(index, all_ids[text], place, int(entry))
        if score is None or score <= out[text].get(item, 0.0):
            continue
        for first in range(max(0, place - index.spans[own] + 1), place + 1):
            if (text, first, own) not in held:
                held[text, first, own] = holds(index, all_words[text], first, own)
            if held[text, first, own]:
                out[text][item] = score
                break
    return out


def build_indexes(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> list[Index]:
    """Indexes of all items with a word; each holds ``INDEX_ITEMS`` items, about, so that it fits a task.

    Document frequencies and the mean length are those of all entries, whatever their index. Repeated items are entries
    of their own; a null or empty text is no item.
    """
    items = stored(benchmark.select(F.col(id_col).alias("item"), or_empty(text_col).alias("text")), "benchmark")
    parts = max(1, math.ceil(items.count() / INDEX_ITEMS))
    part = F.pmod(F.xxhash64("item", "text"), F.lit(parts)).cast("int")

    def terms(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [(p, w, len(words)) for p, text in zip(batch.column("part").to_pylist(), batch.column("text").to_pylist())
                for words, _ in entries_of(text) for w in [None, *sorted(set(words))]]
        return pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.string(), pa.int64()))], ["part", "word", "size"])

    seen = stored(mapped(items.select("text", part.alias("part")), terms, "part int, word string, size bigint"), "benchmark-words")
    n_entries, mean_words = seen.filter("word IS NULL").agg(F.count("*"), F.avg("size")).first()
    frequency = seen.filter("word IS NOT NULL").groupBy("word").agg(F.count("*").alias("n"))
    out = []
    for p in range(parts):
        own = frequency.join(seen.filter(F.col("part") == p).select("word").distinct(), "word").collect()
        rows = items.filter(part == p).orderBy("item", "text").collect()
        out.append(build_index([(r["item"], r["text"]) for r in rows], {r["word"]: r["n"] for r in own}, n_entries, mean_words or 1.0))
    return out


def find_contaminated(docs: DataFrame, indexes: list[Index], id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), item_type: str = "bigint") -> DataFrame:
    """One row per input row: id, columns of ``keep``, contaminated, items (array of (item, score), best first).

    Null and empty texts hold nothing; rows with a null or repeated id are answered one by one; without items nothing is
    contaminated. Texts are read whole. An empty table gives no rows.
    """
    context = docs.sparkSession.sparkContext
    item_arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[item_type]
    found_type = pa.list_(pa.struct([("item", item_arrow), ("score", pa.float64())]))
    found_sql = f"array<struct<item:{item_type},score:double>>"
    passed = ["id", *[f"keep_{c}" for c in keep]]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *[F.col(c).alias(f"keep_{c}") for c in keep], F.expr(f"CAST(array() AS {found_sql})").alias("items"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)

    def step(index: Index):
        holder = context.broadcast(index)

        def of(batch: pa.RecordBatch) -> pa.RecordBatch:
            new = search(holder.value, batch.column("text").to_pylist())
            items = [before + [{"item": i, "score": s} for i, s in hits.items()] for before, hits in zip(batch.column("items").to_pylist(), new)]
            return pa.record_batch([*[batch.column(c) for c in passed[:1]], batch.column("text"), *[batch.column(c) for c in passed[1:]], pa.array(items, found_type)],
                                   batch.schema.names)
        return of

    for index in indexes:
        if index.items:
            rows = mapped(rows, step(index), schema)
    ordered = F.array_sort("items", lambda a, b: F.when(a["score"] > b["score"], -1).when(a["score"] < b["score"], 1)
                           .when(a["item"] < b["item"], -1).when(a["item"] > b["item"], 1).otherwise(0))
    return rows.select(F.col("id").alias(id_col), *[F.col(f"keep_{c}").alias(c) for c in keep], (F.size("items") > 0).alias("contaminated"), ordered.alias("items"))


def drop_contaminated(docs: DataFrame, indexes: list[Index], text_col: str = "text", item_type: str = "bigint") -> DataFrame:
    """The rows of ``docs`` that hold no item, columns as they are."""
    columns = docs.columns
    whole = docs.select(F.struct(*columns).alias("row"), F.col(text_col).alias("text"), F.lit(None).cast("string").alias("id"))
    found = find_contaminated(whole, indexes, "id", "text", ("row",), item_type)
    return found.filter(~F.col("contaminated")).select(*[F.col("row").getField(c).alias(c) for c in columns])
