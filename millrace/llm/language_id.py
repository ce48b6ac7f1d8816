"""Language identification by prediction by partial matching.

Each language has a byte context tree of order ``ORDER``. A byte is coded in the longest context that the tree knows;
a context that never saw the byte codes an escape and hands over to the context one byte shorter, down to a uniform
code over all 256 bytes. Escapes follow method C (a context with n observations of d different bytes gives an escape
d / (n + d)); bytes seen in longer contexts are not excluded. The statistics are frozen before scoring, so the code
length of a text is exact, does not depend on other texts, and the shortest of the languages' lengths wins.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import mapped, utf8

#: Longest context in bytes.
ORDER = 4
#: Bytes of text per language that the trees are learned from, about: whole rows, drawn by a hash of text and language. A longer row is not drawn,
#: but if a language has no other, the beginning of one.
TRAIN_BYTES = 1_500_000
#: Languages whose trees are in one group; a text is scored by group after group.
GROUP_LANGUAGES = 64
#: Code lengths are whole numbers of 2**-SCALE bits, so that sums do not depend on their order.
SCALE = 16
#: Positions scored at once.
CHUNK = 1 << 20
#: A text that no language codes in fewer bits per byte than the plain byte code is in none of them.
PLAIN_BITS = 8.0
UNKNOWN = "und"


@dataclass
class Trees:
    """Trees of a group of languages over one alphabet; ``others`` are the further groups, if any, each with its own.

    ``symbol`` maps a byte to its symbol: 0 for bytes that no tree holds, 1 for the start of a text. ``step[k]`` maps
    (id of the k-gram that ends one place earlier) * width + symbol to the id of the (k+1)-gram, 0 if no tree has it.
    ``cost[k]`` holds, by id of a (k+1)-gram and language, the code length of its last byte in the context of the
    bytes before it; ``escape[k]`` holds, by id of a k-gram and language, the cost of leaving that context.
    """

    languages: list[str]
    symbol: np.ndarray
    width: int
    step: list[np.ndarray]
    cost: list[np.ndarray]
    escape: list[np.ndarray]
    others: list[Trees] = field(default_factory=list)


def _grams(data: np.ndarray, order: int) -> np.ndarray:
    """(order + 1)-grams of symbols below 2**9 that end at each place, as one integer."""
    wide = data.astype(np.int64)
    out = wide.copy()
    for back in range(1, order + 1):
        out[back:] |= wide[:-back] << (9 * back)
    return out


def _padded(data: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Byte values plus 2 with ``order`` starts (1) before each text; starts of the texts in it."""
    n = len(offsets) - 1
    lengths = np.diff(offsets)
    starts = offsets[:-1] + order * np.arange(1, n + 1)
    out = np.ones(len(data) + order * n, np.uint16)
    at = np.repeat(starts - offsets[:-1], lengths) + np.arange(len(data))
    out[at] = data.astype(np.uint16) + 2
    return out, starts


def gram_counts(rows: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, gram, n): how often each (order + 1)-gram occurs in the text of a language."""
    def of(batch: pa.RecordBatch) -> pa.Table | None:
        parts = []
        langs = batch.column("lang").to_pylist()
        for lang in sorted(set(langs)):
            data, offsets = utf8(batch.column("text").filter(pc.equal(batch.column("lang"), lang)))
            padded, starts = _padded(data, offsets, order)
            real = padded > 1
            grams, counts = np.unique(_grams(padded, order)[real], return_counts=True)
            if len(grams):
                parts.append(pa.table({"lang": pa.array([lang] * len(grams)), "gram": grams, "n": counts.astype(np.int64)}))
        return pa.concat_tables(parts) if parts else None

    counted = mapped(rows.select("lang", "text"), of, "lang string, gram bigint, n bigint")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def build_trees(counts: dict[str, tuple[np.ndarray, np.ndarray]], order: int = ORDER) -> Trees:
    """Trees from the counted (order + 1)-grams of each language; bounded by the learned text."""
    languages = sorted(counts)
    used = np.unique(np.concatenate([np.concatenate([(g >> (9 * k)) & 511 for k in range(order + 1)]) for g, _ in counts.values()] or [np.zeros(0, np.int64)]))
    used = used[used > 1]
    symbol = np.zeros(258, np.int64)
    symbol[1] = 1
    symbol[used] = np.arange(2, len(used) + 2)
    width = len(used) + 2
    # Grams of each length as integers in base ``width``, most recent symbol last.
    coded = {lang: sum(symbol[(g >> (9 * k)) & 511] * width ** k for k in range(order + 1)) for lang, (g, _) in counts.items()}
    one = float(1 << SCALE)
    step, known = [], []
    for k in range(order + 1):
        grams = np.unique(np.concatenate([c % width ** (k + 1) for c in coded.values()] + [_contexts(c, width, k, order) for c in coded.values()] or [np.zeros(0, np.int64)]))
        known.append(grams)
        if k == 0:
            table = np.zeros(width, np.int32)
            table[grams] = np.arange(1, len(grams) + 1)
        else:
            shorter = known[k - 1]
            place = np.searchsorted(shorter, grams // width)
            table = np.zeros((len(shorter) + 1) * width, np.int32)
            table[(place + 1) * width + grams % width] = np.arange(1, len(grams) + 1)
        step.append(table)
    cost = [np.zeros((len(g) + 1, len(languages)), np.int64) for g in known]
    escape = [np.zeros((1, len(languages)), np.int64)] + [np.zeros((len(known[k - 1]) + 1, len(languages)), np.int64) for k in range(1, order + 1)]
    uniform = round(8 * one)
    for column, lang in enumerate(languages):
        lower = None
        n = counts[lang][1]
        for k in range(order + 1):
            grams, place = np.unique(coded[lang] % width ** (k + 1), return_inverse=True)
            seen = np.bincount(place, weights=n)
            contexts, of = np.unique(grams // width, return_inverse=True)
            total, kinds = np.bincount(of, weights=seen), np.bincount(of)
            leave = np.rint(-np.log2(kinds / (total + kinds)) * one).astype(np.int64)
            if k == 0:
                escape[0][0, column] = leave[0] if len(leave) else 0
                rows = known[0]
                fallback = np.full(len(rows), uniform + escape[0][0, column], np.int64)
            else:
                escape[k][np.searchsorted(known[k - 1], contexts) + 1, column] = leave
                rows = known[k]
                shorter = rows % width ** k
                at = np.searchsorted(known[k - 1], shorter)
                fallback = lower[at + 1] + escape[k][np.searchsorted(known[k - 1], rows // width) + 1, column]
            values = np.concatenate([[0], fallback])
            values[np.searchsorted(rows, grams) + 1] = np.rint(-np.log2(seen / (total + kinds)[of]) * one).astype(np.int64)
            cost[k][:, column] = lower = values
    return Trees(languages, symbol, width, step, cost, escape)


def _contexts(coded: np.ndarray, width: int, k: int, order: int) -> np.ndarray:
    """Every (k+1)-gram that lies anywhere in the counted grams, so that each known gram has known parts."""
    if k == order:
        return coded[:0]
    return np.unique(np.concatenate([coded // width ** back % width ** (k + 1) for back in range(order - k + 1)]))


def code_lengths(trees: Trees, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Code length of each text by language, in 2**-SCALE bits."""
    n, width, order = len(offsets) - 1, trees.width, len(trees.step) - 1
    padded, starts = _padded(data, offsets, order)
    symbols = trees.symbol[padded]
    ends = starts + np.diff(offsets)
    total = np.zeros((n, len(trees.languages)), np.int64)
    uniform = round(8 * float(1 << SCALE))
    for low in range(0, len(symbols), CHUNK):
        high = min(low + CHUNK, len(symbols))
        first = max(0, low - order)
        part = symbols[first:high]
        ids = [trees.step[0][part].astype(np.int64)]
        for k in range(1, order + 1):
            nxt = np.zeros(len(part), np.int64)
            nxt[k:] = trees.step[k][ids[k - 1][k - 1:-1] * width + part[k:]]
            ids.append(nxt)
        own = slice(low - first, None)
        real = part[own] != 1
        top = ids[order][own]
        lost = np.flatnonzero((top == 0) & real)
        first_text = np.searchsorted(ends, low, side="right")
        last_text = np.searchsorted(starts, high, side="left")
        if first_text >= last_text:
            continue
        cut = np.empty(2 * (last_text - first_text), np.int64)
        cut[0::2] = np.clip(starts[first_text:last_text], low, high) - low
        cut[1::2] = np.clip(ends[first_text:last_text], low, high) - low
        some = cut[1::2] > cut[0::2]
        # A shorter context for the few places that no tree knows in full.
        extra = np.zeros((len(lost), len(trees.languages)), np.int64)
        where, rows = lost + (low - first), np.arange(len(lost))
        for k in range(order, -1, -1):
            if not len(rows):
                break
            if k:
                extra[rows] += trees.escape[k][ids[k - 1][where[rows] - 1]]
                found = ids[k - 1][where[rows]]
                hit = found > 0
                extra[rows[hit]] += trees.cost[k - 1][found[hit]]
                rows = rows[~hit]
            else:
                extra[rows] += trees.escape[0][0] + uniform
        for column in range(len(trees.languages)):
            bits = np.append(trees.cost[order][:, column][top], 0)
            bits[lost] = extra[:, column]
            if some.any():
                # A sum up to the next cut; the ones between texts are left out.
                pairs = cut.reshape(-1, 2)[some].ravel()
                total[np.flatnonzero(some) + first_text, column] += np.add.reduceat(bits, pairs)[0::2]
    return total


def learn(labelled: DataFrame, order: int = ORDER, train_bytes: int = TRAIN_BYTES) -> Trees:
    """Trees from the rows of ``labelled`` (lang, text) with a language, in groups of languages by name.

    One aggregate finds the size of each language; rows are then drawn at a rate that leaves about ``train_bytes``, and the
    row with the least hash always. A language whose rows are all longer than ``train_bytes`` learns from the beginning of one.
    """
    size = F.octet_length("text")
    rows = labelled.select("lang", "text").filter(F.col("lang").isNotNull() & (size > 0)).withColumn("draw", F.xxhash64("text", "lang"))
    short, at = size <= train_bytes, F.pmod("draw", F.lit(1 << 20))
    sizes = (rows.groupBy("lang").agg(F.sum(F.when(short, size)).alias("size"), F.min(F.when(short, F.struct(at.alias("at"), "draw"))).alias("least"),
                                      F.min("draw").alias("least_long")).orderBy("lang").collect())
    if not sizes:
        return build_trees({}, order)
    groups = []
    for low in range(0, len(sizes), GROUP_LANGUAGES):
        part = sizes[low:low + GROUP_LANGUAGES]
        some = [r for r in part if r["size"] is not None]
        rate = {r["lang"]: int(min(1.0, train_bytes / r["size"]) * (1 << 20)) for r in some}
        limit = _by_language([(r["lang"], rate[r["lang"]]) for r in some])
        # The draw of a language from which the rate takes nothing.
        single = _by_language([(r["lang"], r["least"]["draw"]) for r in some if r["least"]["at"] >= rate[r["lang"]]])
        drawn = rows.filter(short & ((at < F.coalesce(limit, F.lit(0))) | F.coalesce(F.col("draw") == single, F.lit(False)))).select("lang", "text")
        long = [(r["lang"], r["least_long"]) for r in part if r["size"] is None]
        if long:
            first = rows.filter(F.col("draw") == _by_language(long)).select("lang", F.substring("text", 1, max(1, train_bytes // 4)).alias("text"))
            drawn = drawn.unionByName(first.dropDuplicates(["lang"]))
        counted = gram_counts(drawn, order).toArrow()
        parts = {lang: counted.filter(pc.equal(counted["lang"], lang)) for lang in counted["lang"].unique().to_pylist()}
        groups.append(build_trees({lang: (g["gram"].to_numpy(), g["n"].to_numpy()) for lang, g in parts.items()}, order))
    return replace(groups[0], others=groups[1:])


def _by_language(values: list[tuple[str, int]]) -> Column:
    """The value of a row's language, null without one."""
    if not values:
        return F.lit(None).cast("bigint")
    return F.element_at(F.create_map(*[x for lang, v in values for x in (F.lit(lang), F.lit(v).cast("bigint"))]), F.col("lang"))


def identify(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: id, columns of ``keep``, lang_pred, score, bits_per_byte and margin_bits.

    ``score`` is the posterior of the best language with equal priors: 2 to the minus code length over the sum of it
    over languages. A text that is null, empty or without a letter is ``und`` with score 0; so is every text when
    there is no language. Ties go to the first language by name. Texts are read whole, in pieces of bounded size.
    Groups of trees are applied one after the other, each keeping the best language, the two least code lengths and the
    sum of weights so far, so that a process holds one group.
    """
    context = docs.sparkSession.sparkContext
    letter = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), letter.alias("letter"), *[F.col(c).alias(f"keep_{c}") for c in keep])
    passed = ["id", *[f"keep_{c}" for c in keep]]
    own = ", ".join(f"{c} {source.schema[c].dataType.simpleString()}" for c in passed)
    groups = [replace(trees, others=[]), *trees.others]

    def step(number: int, group: Trees):
        holder, last = context.broadcast(group), number == len(groups) - 1

        def of(batch: pa.RecordBatch) -> pa.RecordBatch:
            t = holder.value
            data, offsets = utf8(batch.column("text"))
            n = len(offsets) - 1
            some = np.array(batch.column("letter").to_pylist(), bool) & bool(t.languages)
            if t.languages:
                bits = code_lengths(t, data, offsets) / float(1 << SCALE)
                best = bits.argmin(axis=1)
                least = bits[np.arange(n), best]
                weight = np.exp2(-np.minimum(bits - least[:, None], 1000.0)).sum(axis=1)
                second = np.partition(bits, 1, axis=1)[:, 1] if len(t.languages) > 1 else np.full(n, np.inf)
                names = [t.languages[b] for b in best]
            else:
                least, weight, second, names = np.zeros(n), np.ones(n), np.full(n, np.inf), [UNKNOWN] * n
            if number:
                before = {c: batch.column(c).to_numpy() for c in ("least", "second", "weight")}
                stays = before["least"] <= least
                now = np.minimum(before["least"], least)
                second = np.minimum(np.maximum(before["least"], least), np.minimum(before["second"], second))
                weight = (before["weight"] * np.exp2(-np.minimum(before["least"] - now, 1000.0))
                          + weight * np.exp2(-np.minimum(least - now, 1000.0)))
                names, least = [a if s else b for s, a, b in zip(stays, batch.column("name").to_pylist(), names)], now
            if not last:
                return pa.record_batch([batch.column("id"), batch.column("text"), batch.column("letter"), *[batch.column(c) for c in passed[1:]],
                                        pa.array(names, pa.string()), pa.array(least), pa.array(second), pa.array(weight)],
                                       ["id", "text", "letter", *passed[1:], "name", "least", "second", "weight"])
            rate = np.where(some, least / np.maximum(np.diff(offsets), 1), 0.0)
            margin = np.where(some & np.isfinite(second), second - least, 0.0)
            return pa.record_batch([*[batch.column(c) for c in passed], pa.array([x if s else UNKNOWN for x, s in zip(names, some)], pa.string()),
                                    pa.array(np.where(some, 1.0 / weight, 0.0)), pa.array(rate), pa.array(margin)],
                                   [*passed, "lang_pred", "score", "bits_per_byte", "margin_bits"])
        return of

    between = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in source.schema) + ", name string, least double, second double, weight double"
    out = source
    for number, group in enumerate(groups):
        last = number == len(groups) - 1
        out = mapped(out, step(number, group), f"{own}, lang_pred string, score double, bits_per_byte double, margin_bits double" if last else between)
    return out.select(F.col("id").alias(id_col), *[F.col(f"keep_{c}").alias(c) for c in keep], "lang_pred", "score", "bits_per_byte", "margin_bits")


def keep_identified(docs: DataFrame, trees: Trees, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in a learned language, columns as they are.

    Rejected are ``und`` rows and texts that the best language codes no shorter than the plain byte code.
    """
    columns = docs.columns
    whole = docs.select(F.struct(*columns).alias("row"), F.col(text_col).alias("text"))
    named = identify(whole.withColumn("id", F.lit(None).cast("string")), trees, "id", "text", keep=("row",))
    kept = named.filter((F.col("lang_pred") != UNKNOWN) & (F.col("bits_per_byte") < PLAIN_BITS))
    return kept.select(*[F.col("row").getField(c).alias(c) for c in columns])
