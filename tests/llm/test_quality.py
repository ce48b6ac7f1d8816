import math
import random
import re
from collections import Counter

import pytest

from millrace.llm import quality as m


def slow_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    threes = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    times = Counter(threes)
    repeated = {i + d for i, t in enumerate(threes) if times[t] > 1 for d in range(3)}
    lines, seen, doubled = text.split("\n"), set(), 0
    for line in lines:
        if re.search(r"[^\x20\x09-\x0D]", line):
            doubled += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), doubled, len(repeated)


def test_fixed_counts():
    r = random.Random(0)
    for _ in range(300):
        text = "".join(r.choices(["a", "b ", "c\n", " ", "\n\n", "é", " x", "#", "\x0b", "\x1c", " "], k=r.randint(0, 80)))
        assert m.fixed_counts(text.encode()) == slow_counts(text)


def slow_references(rows):
    out = {}
    for lang in sorted({lang for _, _, lang in rows if lang is not None}):
        words = Counter(w.lower().strip(b".,;:!?") for _, t, own in rows if own == lang and t for w in t.encode().split())
        total = sum(words.values())
        if total:
            out[lang] = (total, sorted(w for w, n in words.items() if w and n >= total * m.COMMON_SHARE), words)
    return out


@pytest.mark.parametrize("flush", [3, 400_000])
def test_references_are_exact(spark, monkeypatch, flush):
    monkeypatch.setattr(m, "FLUSH_WORDS", flush)
    monkeypatch.setattr(m, "COMMON_SHARE", 0.05)
    r = random.Random(1)
    rows = [(i, " ".join(r.choices(["the", "of", "A", "b.", "c,", "rare%d" % i, "x%d" % (i % 7)], weights=[9, 5, 3, 2, 1, 1, 2], k=r.randint(0, 60))), r.choice(["en", "de", None])) for i in range(80)]
    rows.append((99, None, "en"))
    want = slow_references(rows)
    got = m.build_references(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5), share=0.05)
    assert [x.lang for x in got] == list(want)
    for ref in got:
        total, common, words = want[ref.lang]
        assert ref.words == common
        shares = [words[w] / total for w in common]
        assert ref.shares.tolist() == pytest.approx(shares + [1 - sum(shares)])
        assert ref.classes.sum() == pytest.approx(1)


def test_distance():
    import numpy as np
    p, q = np.array([1.0, 0, 0]), np.array([0, 0.5, 0.5])
    assert m.js_distance(p, p) == 0 and m.js_distance(p, q) == pytest.approx(1)
    assert m.js_distance(np.array([0.5, 0.5]), np.array([1.0, 0])) == pytest.approx(math.sqrt((0.5 * math.log2(0.5 / 0.75) + 0.5 + math.log2(1 / 0.75)) / 2))


def test_table(spark):
    clean = " ".join(f"the w{i}, of v{i}" for i in range(60))
    junk = " | ".join(f"@@{i}" for i in range(200))
    rows = [(1, clean, "en"), (1, clean, "en"), (None, None, None), (2, "", "en"), (3, junk, None), (4, "same words here " * 40, "en"), (5, "short", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 AS id", "2 AS kept")
    refs = m.build_references(df.filter("doc_id = 1"))
    got = sorted(((r["doc_id"], r["base_failed"], r["kept"]) for r in m.judge(df, refs).collect()), key=str)
    assert got == sorted([(1, False, True), (1, False, True), (None, True, False), (2, True, False), (3, False, False), (4, True, False), (5, True, False)], key=str)
    assert all(r["kept"] != r["base_failed"] for r in m.judge(df, []).collect())
    assert m.judge(df.limit(0), refs).collect() == [] and m.build_references(df.limit(0)) == []


def test_query_counts_and_labels(spark):
    from millrace.llm.queries import QUERIES
    folder = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = {r["doc_id"]: r for r in QUERIES["op10_quality_rules"](spark, folder).collect()}
    for i, text in texts.items():
        assert tuple(found[i][c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == slow_counts(text)
    good = [r["doc_id"] for r in spark.read.parquet(f"{folder}/labels.parquet").filter("quality = 1").collect() if not found[r["doc_id"]]["base_failed"]]
    assert sum(found[i]["kept"] for i in good) >= 0.99 * len(good)
