"""Repeated line runs by a suffix array over line numbers, built by distributed prefix doubling.

Lines become ranks in sorted order. Each doubling sorts the distinct pairs (rank of 2**k lines, rank of the next 2**k
lines) over the cluster and numbers them in that order, which is the suffix array by its first 2**(k + 1) lines. Pairs
that occur once are settled: no run passes over them. Suffixes that share their first m lines are an interval of the
array whose common prefix is at least m long; an interval with more than one suffix is a repeated run.

A run counts if it has ``min_words`` words or more. All lines of such a run lie in shortest qualifying windows of it, by
start or by end: if p is a line of the run, either the shortest window from p, the one up to p, or one that starts
before p and ends after it fits into the run. So intervals are needed only at the window lengths, at most ``min_words``
lines, and doubling ends there; the runs found are the maximal ones.

Only DataFrame functions are used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import or_empty, stored

#: Words from which a repeated run is deleted.
MIN_WORDS = 50
#: White space at the ends of a line does not count; fixed values.
WHITE = " \t\r\x0b\x0c"
WORD = r"[^ \t\r\x0b\x0c]+"


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, d, j, i, w, k1, k2): d tells texts of one id apart, j counts lines with a word, i all lines, w words."""
    text = or_empty(text_col)
    trimmed = F.transform(F.split(text, "\n"), lambda x, i: F.struct(i.alias("i"), F.btrim(x, F.lit(WHITE)).alias("line")))
    return (docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("d"), F.posexplode(F.filter(trimmed, lambda x: x["line"] != "")).alias("j", "x"))
            .select("id", "d", "j", F.col("x.i").alias("i"), F.regexp_count(F.col("x.line"), F.lit(WORD)).alias("w"),
                    F.xxhash64("x.line").alias("k1"), F.xxhash64(F.lit("second"), F.col("x.line")).alias("k2")))


def _ranked(rows: DataFrame, keys: list[str], name: str, label: str) -> DataFrame:
    """Distinct keys that occur more than once, numbered in sorted order over all partitions."""
    repeated = rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1").select(*keys)
    return stored(repeated.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(name, F.monotonically_increasing_id()), label)


def _positions(lines: DataFrame, min_words: int) -> DataFrame:
    """Repeated lines with their rank, in stretches (seg) of consecutive ones, and window lengths up and down.

    ``ahead``: lines of the shortest window of ``min_words`` words that starts here; ``back``: of the one that ends
    here; null where the stretch is too short. Stored, as later steps read it several times.
    """
    found = lines.join(_ranked(lines, ["k1", "k2"], "rank", "line-ranks"), ["k1", "k2"]).select("id", "d", "j", "i", "w", "rank")
    doc = Window.partitionBy("id", "d")
    seg = Window.partitionBy("id", "d", "seg")
    placed = (found.repartition("id", "d").dropDuplicates(["id", "d", "j"])
              .withColumn("seg", F.col("j") - F.row_number().over(doc.orderBy("j")))
              .withColumn("end", F.sum("w").over(seg.orderBy("j")))
              .withColumn("total", F.sum("w").over(seg))
              .withColumn("start", F.col("end") - F.col("w")))
    ahead = F.count("*").over(seg.orderBy("start").rangeBetween(0, min_words - 1))
    back = F.count("*").over(seg.orderBy("end").rangeBetween(1 - min_words, 0))
    return stored(placed.select(
        "id", "d", "seg", "j", "i", "rank", F.when(F.col("total") - F.col("start") >= min_words, ahead).cast("int").alias("ahead"),
        F.when(F.col("end") >= min_words, back).cast("int").alias("back")), "line-places")


def _windows(places: DataFrame) -> DataFrame:
    """(id, d, first, m): the windows of m lines that begin at line ``first``."""
    ahead = places.filter("ahead IS NOT NULL").select("id", "d", F.col("j").alias("first"), F.col("ahead").alias("m"))
    back = places.filter("back IS NOT NULL").select("id", "d", (F.col("j") - F.col("back") + 1).alias("first"), F.col("back").alias("m"))
    return ahead.union(back).distinct()


def _doubled(names: DataFrame, step: int) -> DataFrame:
    """Ranks of 2 * step lines from ranks of step lines; null where a run ends or is settled."""
    pairs = names.withColumn("next", F.lead("rank", step).over(Window.partitionBy("id", "d", "seg").orderBy("j")))
    ranks = _ranked(pairs.filter("rank IS NOT NULL AND next IS NOT NULL"), ["rank", "next"], "longer", "run-ranks")
    return stored(pairs.join(ranks, ["rank", "next"], "left").select("id", "d", "seg", "j", F.col("longer").alias("rank")), "run-places")


def _later_copies(windows: DataFrame, names: DataFrame, width: int) -> DataFrame:
    """(id, d, first, reach): windows of width to 2 * width - 1 lines whose lines stand at an earlier place too.

    A window is told by its length and the ranks of its first and its last ``width`` lines.
    """
    some = names.filter("rank IS NOT NULL").select("id", "d", "j", "rank")
    same = lambda place: [F.col("x.id").eqNullSafe(F.col("y.id")), F.col("x.d") == F.col("y.d"), place == F.col("y.j")]
    own = (windows.filter(F.col("m").between(width, 2 * width - 1)).alias("x").join(some.alias("y"), same(F.col("x.first")))
           .select("x.*", F.col("y.rank").alias("head")))
    # Both sides of the last join are written tables, so that Spark can split an interval of very many copies.
    own = stored(own.alias("x").join(some.alias("y"), same(F.col("x.first") + F.col("x.m") - width))
                 .select("x.*", F.col("y.rank").alias("tail")), "window-names")
    interval = stored(own.groupBy("m", "head", "tail").agg(F.min(F.struct("id", "d", "first")).alias("least"), F.count("*").alias("n"))
                      .filter("n > 1").drop("n"), "intervals")
    return (own.join(interval, ["m", "head", "tail"]).filter(F.struct("id", "d", "first") > F.col("least"))
            .select("id", "d", "first", (F.col("first") + F.col("m") - 1).alias("reach")))


def deleted_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(id, d, gone): for each text with later copies, an array that is true at its deleted lines; d is the text's XXH64."""
    places = _positions(_lines(docs, id_col, text_col), min_words)
    windows = stored(_windows(places), "windows")
    longest = windows.agg(F.max("m")).first()[0] or 0
    names, width, copies = places.select("id", "d", "seg", "j", "rank"), 1, []
    while width <= longest:
        copies.append(_later_copies(windows, names, width))
        if 2 * width <= longest:
            names = _doubled(names, width)
        width *= 2
    if not copies:
        return places.select("id", "d", F.array(F.lit(True)).alias("gone")).limit(0)
    reach = reduce(DataFrame.union, copies).groupBy("id", "d", "first").agg(F.max("reach").alias("reach"))
    seg, doc = Window.partitionBy("id", "d", "seg").orderBy("j"), Window.partitionBy("id", "d").orderBy("low")
    covered = (places.alias("x").join(reach.alias("y"), [F.col("x.id").eqNullSafe(F.col("y.id")), F.col("x.d") == F.col("y.d"), F.col("x.j") == F.col("y.first")], "left")
               .select("x.id", "x.d", "x.seg", "x.j", "x.i", "y.reach")
               .withColumn("until", F.max("reach").over(seg)).filter("until >= j"))
    runs = (covered.withColumn("run", F.col("j") - F.row_number().over(Window.partitionBy("id", "d").orderBy("j")))
            .groupBy("id", "d", "run").agg(F.min("i").alias("low"), F.max("i").alias("high"))
            .withColumn("gap", F.col("low") - F.coalesce(F.lag("high").over(doc) + 1, F.lit(0))))
    parts = F.transform(F.sort_array(F.collect_list(F.struct("low", "gap", "high"))), lambda r: F.concat(
        F.array_repeat(F.lit(False), r["gap"]), F.array_repeat(F.lit(True), r["high"] - r["low"] + 1)))
    return runs.groupBy("id", "d").agg(F.flatten(parts).alias("gone"))


def _marked(docs: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """Rows of ``docs`` as (row, text, gone); ``gone`` is null where nothing is deleted."""
    gone = deleted_lines(docs, id_col, text_col, min_words)
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("_id"), F.xxhash64(or_empty(text_col)).alias("_d"))
    return rows.join(gone, [F.col("_id").eqNullSafe(F.col("id")), F.col("_d") == F.col("d")], "left").select("row", "gone")


def _kept_text(text: Column) -> Column:
    left = F.filter(F.split(text, "\n"), lambda _, i: ~F.coalesce(F.get("gone", i), F.lit(False)))
    return F.when(F.col("gone").isNull(), text).otherwise(F.array_join(left, "\n"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """One row per input row: id, text without later copies, n_lines, n_removed.

    Lines are cut at line feeds and compared without white space at their ends; lines without a word count as no line
    of a run, and go if they lie inside a deleted one. Places are ordered by (id, XXH64 of the text, line), null ids
    first; of equal windows of lines the first place stays, so of a run that overlaps its own copy only the beginning
    does. Rows that repeat both id and text are one document and get the same answer. A null text stays null, with no
    lines. Texts are read whole; an empty table gives no rows.
    """
    text = F.col("row").getField(text_col)
    return _marked(docs, id_col, text_col, min_words).select(
        F.col("row").getField(id_col).alias(id_col), _kept_text(text).alias(text_col),
        F.when(text.isNull(), F.lit(0)).otherwise(F.size(F.split(text, "\n"))).cast("long").alias("n_lines"),
        F.coalesce(F.size(F.filter("gone", lambda x: x)), F.lit(0)).cast("long").alias("n_removed"))


def replace_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of ``docs`` with later copies taken out of their texts; a row goes if that leaves it without a word."""
    text = F.col("row").getField(text_col)
    rows = _marked(docs, id_col, text_col, min_words).withColumn("_kept", _kept_text(text))
    kept = rows.filter(F.col("gone").isNull() | (F.btrim("_kept", F.lit(WHITE + "\n")) != ""))
    return kept.select(*[F.col("_kept").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns])
