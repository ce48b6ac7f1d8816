import hashlib

import pytest
from pyspark.sql import functions as F

from millrace.llm import merkle

SCHEMA = "doc_id long, lang string, n_chars long, text string, slot_ string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(digests, arity):
    """The root of a list of digests, and for each its hops (siblings before, after)."""
    hops, where, now = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(now) > 1:
        for i, at in enumerate(where):
            first = at // arity * arity
            hops[i].append(("".join(now[first:at]), "".join(now[at + 1:first + arity])))
            where[i] = at // arity
        now = [sha(*now[i:i + arity]) for i in range(0, len(now), arity)]
    return now[0], hops


def slow_manifest(rows, arity):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, sha(*[plain_field(x) for x in r[:4]])))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = [climb([x[2] for x in sorted(groups[g])], arity) for g in order]
    root, above = climb([t[0] for t in trees], arity)
    out = []
    for g, (subroot, hops), up in zip(order, trees, above):
        for (known, i, leaf), hop in zip(sorted(groups[g]), hops):
            out.append((i if known else None, g, leaf, subroot, root, tuple(hop + up)))
    return sorted(out, key=str)


def fast_manifest(spark, rows, arity):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    made = docs.withColumn("leaf", merkle.leaf_digest([F.col(c) for c in ("doc_id", "lang", "n_chars", "text")]))
    out = merkle.manifest(made, "lang", ["doc_id"], keep=("doc_id", "lang", "n_chars"), arity=arity)
    return out, sorted(((r["doc_id"], r["lang"], r["leaf"], r["subroot"], r["root"], tuple((h["before"], h["after"]) for h in r["hops"]))
                        for r in out.collect()), key=str)


@pytest.mark.parametrize(("arity", "levels"), [(2, 8), (2, 2), (3, 2)])
def test_equals_slow_manifest(spark, monkeypatch, arity, levels):
    """Hot group, lone rows, nulls in every column, repeated rows and ids, empty and long texts, several tiers."""
    monkeypatch.setattr(merkle, "LEVELS", levels)
    rows = [(i, "en", i, f"text {i}", "x") for i in range(41)] + [(i, "de", None, "", None) for i in range(7)]
    rows += [(3, "en", 3, "text 3", "x")] * 5 + [(3, "en", 3, "other", "x"), (None, "en", None, None, None), (1, None, 4, "ä€😀", "x"), (9, "fr", 1, "w " * 50_000, "x")]
    out, got = fast_manifest(spark, rows, arity)
    assert got == slow_manifest(rows, arity)
    assert merkle.verify(out).filter("NOT verified").count() == 0
    changed = merkle.verify(out.withColumn("leaf", F.when(F.col("n_chars") == 5, F.sha2(F.lit("?"), 256)).otherwise(F.col("leaf"))))
    assert {(r["n_chars"] == 5, r["verified"]) for r in changed.collect()} == {(True, False), (False, True)}


def test_lone_rows_and_empty_table(spark):
    rows = [(1, "en", 1, "a", None)]
    out, got = fast_manifest(spark, rows, 2)
    assert got == slow_manifest(rows, 2) and got[0][2] == got[0][3] == got[0][4]
    assert merkle.verify(out).first()["verified"]
    empty = spark.createDataFrame([], SCHEMA).withColumn("leaf", F.lit("x"))
    assert merkle.verify(merkle.manifest(empty, "lang", ["doc_id"])).count() == 0


def test_clashing_names(spark):
    rows = spark.createDataFrame([(1, "a", "b", "c", 5), (2, "a", "d", "e", 6)], "id long, root string, leaf string, grp string, slot int")
    out = merkle.manifest(rows.withColumn("mine", F.sha2("leaf", 256)), "root", ["id"], "mine", keep=("grp", "slot"))
    assert out.columns == ["grp", "slot", "leaf", "subroot", "root", "hops"] and merkle.verify(out).filter("verified").count() == 2


def test_one_group_holds_all_rows_in_many_tasks(spark):
    """A window partition is one block, however large the group is."""
    nodes = spark.range(3000).select(F.lit("=en").alias("grp"), F.col("id").alias("slot"), F.lit(3000).cast("long").alias("n"),
                                     F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    tier = merkle._tier(nodes, 2)
    assert tier.groupBy("grp", "block").count().agg(F.max("count")).first()[0] == 2 ** merkle.LEVELS
    assert "SinglePartition" not in tier._jdf.queryExecution().executedPlan().toString()
