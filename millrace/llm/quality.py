"""Quality rules: fixed counts, and the divergence of a text from what its language looks like.

References are the character-class and common-word histograms of each language, summed over all documents. A text is
compared with the closest reference by Jensen-Shannon distance (base 2, 0 to 1); a guard on length keeps short texts,
whose histograms are noise, from being judged.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import byte_texts, mapped, or_empty

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A word is common in a language if it is at least this share of the language's words; so there are at most 1 / share.
COMMON_SHARE = 0.004
#: Distances from which a text fails, and the length from which each is judged.
MAX_CLASS_DISTANCE, MIN_CLASS_BYTES = 0.30, 200
MAX_WORD_DISTANCE, MIN_WORD_COUNT = 0.43, 50
#: Distinct words counted at once in a task before they are handed on.
FLUSH_WORDS = 400_000

#: Character classes by byte value; continuation bytes of UTF-8 are in none.
CLASSES = ("lower", "upper", "digit", "space", "stop", "quote", "symbol", "control", "wide")
_CLASS = np.full(256, 7, np.uint8)
_CLASS[ord("a"):ord("z") + 1], _CLASS[ord("A"):ord("Z") + 1], _CLASS[ord("0"):ord("9") + 1] = 0, 1, 2
_CLASS[[ord(c) for c in " \n"]], _CLASS[[ord(c) for c in ".,;:!?"]], _CLASS[[ord(c) for c in "'\"()-"]] = 3, 4, 5
_CLASS[[ord(c) for c in "#*$%&|<>@+=/\\_~^`[]{}"]] = 6
_CLASS[0x80:0xC0], _CLASS[0xC0:] = 9, 8
_WHITE = b" \t\n\x0b\x0c\r"


@dataclass
class Reference:
    """Histograms of one language as shares; the last word share is that of all other words."""

    lang: str
    classes: np.ndarray
    words: list[bytes]
    shares: np.ndarray


def class_counts(text: bytes) -> np.ndarray:
    return np.bincount(_CLASS[np.frombuffer(text, np.uint8)], minlength=10)[:len(CLASSES)]


def _plain(word: bytes) -> bytes:
    return word.lower().strip(b".,;:!?")


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Square root of the Jensen-Shannon divergence in bits of two share vectors."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = np.where(p > 0, p * np.log2(p / m), 0.0).sum() + np.where(q > 0, q * np.log2(q / m), 0.0).sum()
    return float(np.sqrt(min(1.0, max(0.0, parts / 2))))


def fixed_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    words = text.split()
    string = text.decode("utf-8", "replace")
    white = sum(text.count(c) for c in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"))
    symbols = sum(text.count(c.encode()) for c in SYMBOLS)
    seen, doubled = set(), 0
    if b"\n" in text:
        for line in text.split(b"\n"):
            if line.strip(_WHITE):
                doubled += line in seen
                seen.add(line)
    threes = list(zip(words, islice(words, 1, None), islice(words, 2, None)))
    repeated = 0
    if len(set(threes)) < len(threes):
        times = Counter(threes)
        until = 0
        for at, three in enumerate(threes):
            if times[three] > 1:
                repeated += at + 3 - max(until, at)
                until = at + 3
    return len(words), len(string) - white, symbols, doubled, repeated


def _segments(batches, lang_index: int, text_index: int):
    """Word counts and class counts by language, in segments that hold a bounded number of distinct words."""
    words: dict[str, Counter] = {}
    classes: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column(lang_index).to_pylist(), byte_texts(batch.column(text_index))):
            if lang is None:
                continue
            own = words.setdefault(lang, Counter())
            own.update(map(_plain, text.split()))
            classes[lang] = classes.get(lang, 0) + class_counts(text)
            if len(own) > FLUSH_WORDS:
                yield lang, words.pop(lang), classes.pop(lang)
    for lang in words:
        yield lang, words[lang], classes[lang]


def build_references(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", share: float = COMMON_SHARE) -> list[Reference]:
    """References from all documents with a language.

    A word with a share s of a language's words has a share of s / 2 in segments that hold at least half of it. So
    segments hand on the words above s / 2, and those whose sum reaches s / 2 of all words are at most 2 / s and include
    every common word; a second pass counts these exactly.
    """
    source = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter(F.col("lang").isNotNull())
    names = pa.schema([("lang", pa.string()), ("kind", pa.string()), ("word", pa.binary()), ("n", pa.int64())])

    def first(batches):
        for lang, words, classes in _segments(batches, 0, 1):
            total = sum(words.values())
            rows = [(lang, "total", b"", total)] + [(lang, "class", c.encode(), int(n)) for c, n in zip(CLASSES, classes)]
            rows += [(lang, "word", w, n) for w, n in words.items() if n >= total * share / 2 and w]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), names)], schema=names)

    counted = (source.mapInArrow(first, "lang string, kind string, word binary, n bigint")
               .groupBy("lang", "kind", "word").agg(F.sum("n").alias("n")))
    totals = counted.filter(F.col("kind") == "total").select(F.col("lang").alias("_lang"), F.col("n").alias("_total"))
    kept = (counted.join(totals, counted["lang"] == totals["_lang"]).filter((F.col("kind") != "word") | (F.col("n") >= F.col("_total") * share / 2))
            .select("lang", "kind", "word", "n").collect())
    candidates: dict[str, set[bytes]] = {}
    total, classes = {}, {}
    for row in kept:
        if row["kind"] == "total":
            total[row["lang"]] = row["n"]
        elif row["kind"] == "class":
            classes.setdefault(row["lang"], {})[bytes(row["word"]).decode()] = row["n"]
        else:
            candidates.setdefault(row["lang"], set()).add(bytes(row["word"]))

    def second(batches):
        for lang, words, _ in _segments(batches, 0, 1):
            rows = [(lang, "word", w, words[w]) for w in candidates.get(lang, ()) if w in words]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), names)], schema=names)

    exact = (source.mapInArrow(second, "lang string, kind string, word binary, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n")).collect()
             if candidates else [])
    common: dict[str, list[tuple[bytes, int]]] = {}
    for row in exact:
        if row["n"] >= total[row["lang"]] * share:
            common.setdefault(row["lang"], []).append((bytes(row["word"]), row["n"]))
    out = []
    for lang in sorted(total):
        if not total[lang]:
            continue
        words = sorted(common.get(lang, []))
        counts = np.array([n for _, n in words] + [total[lang] - sum(n for _, n in words)], float)
        shape = np.array([classes[lang].get(c, 0) for c in CLASSES], float)
        out.append(Reference(lang, shape / max(shape.sum(), 1), [w for w, _ in words], counts / counts.sum()))
    return out


def distances(text: bytes, references: list[Reference]) -> tuple[str | None, float, float]:
    """The language whose character classes and words together lie closest, and both distances; zeros without one."""
    shape = class_counts(text).astype(float)
    if not references or not shape.sum():
        return None, 0.0, 0.0
    shape /= shape.sum()
    words = Counter(map(_plain, text.split()))
    total = sum(words.values())
    best = None
    for r in references:
        own = np.array([words.get(w, 0) for w in r.words], float)
        shares = np.append(own, total - own.sum()) / max(total, 1)
        found = (js_distance(shape, r.classes), js_distance(shares, r.shares) if total else 0.0)
        if best is None or sum(found) < sum(best[1:]):
            best = (r.lang, *found)
    return best


def judge(docs: DataFrame, references: list[Reference], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, the fixed counts, base_failed, kept, ref_lang, class_distance, word_distance.

    ``base_failed``: fewer than ``MIN_WORDS`` words, or more than ``MAX_REPEAT_PERCENT`` of them in repeated windows.
    ``kept``: not base_failed, and no distance over its limit where the text is long enough to be judged. A null or
    empty text has no words and fails. Without references only the fixed rules count. Texts are read whole.
    """
    holder = docs.sparkSession.sparkContext.broadcast(references)
    source = docs.select(F.col(id_col).alias("id"), or_empty(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    longs = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def of(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, verdicts = [], []
        for text in byte_texts(batch.column("text")):
            own = fixed_counts(text)
            failed = own[0] < MIN_WORDS or 100 * own[4] > MAX_REPEAT_PERCENT * own[0]
            lang, by_class, by_word = distances(text, holder.value)
            odd = (len(text) >= MIN_CLASS_BYTES and by_class > MAX_CLASS_DISTANCE) or (own[0] >= MIN_WORD_COUNT and by_word > MAX_WORD_DISTANCE)
            counts.append(own)
            verdicts.append((failed, not failed and not odd, lang, by_class, by_word))
        columns = [pa.array([c[i] for c in counts], pa.int64()) for i in range(5)]
        types = (pa.bool_(), pa.bool_(), pa.string(), pa.float64(), pa.float64())
        columns += [pa.array([v[i] for v in verdicts], t) for i, t in enumerate(types)]
        return pa.record_batch([batch.column("id"), *columns], ["id", *longs, "base_failed", "kept", "ref_lang", "class_distance", "word_distance"])

    schema = f"id {kind}, {', '.join(f'{c} bigint' for c in longs)}, base_failed boolean, kept boolean, ref_lang string, class_distance double, word_distance double"
    return mapped(source, of, schema).withColumnRenamed("id", id_col)
