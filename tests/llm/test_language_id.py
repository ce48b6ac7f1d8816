import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from millrace.llm import language_id as m

TEXTS = {"aa": ["abra cadabra", "bracada", "é a"], "bb": ["xyz zyx yy", "zzxy", "xx é yz"], "cc": ["abc xyz"]}


def slow_bits(texts, text, order):
    """Plain method C with escapes down to the uniform code."""
    seen = defaultdict(Counter)
    for t in texts:
        data = [1] * order + [b + 2 for b in t.encode()]
        for i in range(order, len(data)):
            for k in range(order + 1):
                seen[tuple(data[i - k:i])][data[i]] += 1
    total = 0
    data = [1] * order + [b + 2 for b in text.encode()]
    for i in range(order, len(data)):
        for k in range(order, -1, -1):
            c = seen.get(tuple(data[i - k:i]))
            if c is None:
                continue
            n, d = sum(c.values()), len(c)
            if data[i] in c:
                total += round(-math.log2(c[data[i]] / (n + d)) * 65536)
                break
            total += round(-math.log2(d / (n + d)) * 65536)
        else:
            total += 8 * 65536
    return total


@pytest.mark.parametrize("chunk", [5, 1 << 20])
@pytest.mark.parametrize("order", [0, 1, 4])
def test_code_lengths_are_exact(spark, monkeypatch, order, chunk):
    monkeypatch.setattr(m, "CHUNK", chunk)
    rows = spark.createDataFrame([(lang, t) for lang, ts in TEXTS.items() for t in ts], "lang string, text string")
    trees = m.learn(rows, order)
    r = random.Random(0)
    queries = ["", "a", "é", "abra", "q", "xyzzy abra ßß", "".join(r.choices("abcxyz é", k=300)), ""]
    data = [q.encode() for q in queries]
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    got = m.code_lengths(trees, np.frombuffer(b"".join(data), np.uint8), offsets)
    assert trees.languages == ["aa", "bb", "cc"]
    assert got.tolist() == [[slow_bits(TEXTS[lang], q, order) for lang in trees.languages] for q in queries]


def test_table(spark):
    rows = spark.createDataFrame([("aa", "abra cadabra"), ("bb", "xyz zyx"), (None, "never"), ("aa", None), ("cc", "")], "lang string, text string")
    trees = m.learn(rows)
    assert trees.languages == ["aa", "bb"]
    docs = [(1, "abra", "x"), (1, "abra", "x"), (None, "zyx", "y"), (2, None, None), (3, "", "z"), (4, "123 !?", "z"), (5, "abra " * 50000, "z")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang_pred string").selectExpr("*", "1 AS id", "2 AS letter", "3 AS row")
    got = sorted(((r["doc_id"], r["lang_pred"]) for r in m.identify(df, trees).collect()), key=str)
    assert got == sorted([(1, "aa"), (1, "aa"), (None, "bb"), (2, "und"), (3, "und"), (4, "und"), (5, "aa")], key=str)
    assert all(0 <= r["score"] <= 1 for r in m.identify(df, trees).collect())
    kept = m.keep_identified(df, trees)
    assert kept.columns == df.columns and sorted((r["doc_id"] for r in kept.collect()), key=str) == [1, 1, 5, None]
    assert m.identify(df.limit(0), trees).collect() == []
    nothing = m.learn(rows.limit(0))
    assert {r["lang_pred"] for r in m.identify(df, nothing).collect()} == {"und"}


def test_held_out_accuracy(spark):
    from millrace.llm.queries import QUERIES
    folder = "/root/testdata/sf0.01"
    found = QUERIES["op1_language_id"](spark, folder).join(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = found.filter("held_out").selectExpr("avg(CAST(lang_pred = lang AS double)) AS right").first()
    assert held["right"] > 0.98
