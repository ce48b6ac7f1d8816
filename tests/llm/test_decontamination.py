import math
import random
from collections import Counter

import pytest

from millrace.llm import decontamination as m


def slow_search(items, text):
    """Every passage against every entry, scored and verified in full."""
    entries = [(i, words, cut) for i, t in items for words, cut in m.entries_of(t or "")]
    n, mean = len(entries), sum(len(w) for _, w, _ in entries) / max(1, len(entries))
    df = Counter(w for _, words, _ in entries for w in set(words))
    words, found = m.words_of(text or ""), {}
    for low in range(0, max(1, len(words)), m.STRIDE):
        passage = words[low:low + m.PASSAGE_WORDS]
        for item, own, cut in entries:
            norm = m.K1 * (1 - m.B + m.B * len(own) / mean)
            score = {w: math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * tf * (m.K1 + 1) / (tf + norm) for w, tf in Counter(own).items()}
            share = sum(s for w, s in score.items() if w in set(passage)) / sum(score.values())
            size = min(5, len(own))
            grams = [tuple(own[i:i + size]) for i in range(len(own) - size + 1)]
            here = {tuple(passage[i:i + size]) for i in range(len(passage) - size + 1)}
            parts = [set(grams[:cut]), set(grams[cut:])]
            if share >= m.MIN_SCORE - 1e-9 and len(set(grams) & here) >= m.MIN_OVERLAP * len(set(grams)) and all(len(p & here) >= m.MIN_PART * len(p) for p in parts):
                found[item] = max(found.get(item, 0), share)
    return found


def made(seed=0):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["the", "of"] * 40
    items = [(i, " ".join(r.choices(words, k=r.choice([2, 6, 30, 64, 65, 150])))) for i in range(90)]
    items += [(90, items[0][1]), (91, "what is it? an answer of several words here"), (92, None), (93, ""), (94, "?")]
    docs = []
    for i in range(60):
        text = r.choices(words, k=r.randint(0, 400))
        for _ in range(r.randint(0, 3)):
            part = (r.choice(items)[1] or "").split()
            for _ in range(r.randint(0, 2)):
                if part:
                    part[r.randrange(len(part))] = "changed"
            at = r.randint(0, len(text))
            text[at:at] = [w.upper() + r.choice(["", ",", "***"]) for w in part]
        docs.append(" ".join(text))
    return items, docs + [None, "", "the " * 20000, "nothing known"]


@pytest.mark.parametrize("block", [1, 32])
@pytest.mark.parametrize("per_index", [20_000, 40])
def test_equals_brute_force(spark, monkeypatch, block, per_index):
    monkeypatch.setattr(m, "BLOCK", block)
    monkeypatch.setattr(m, "INDEX_ITEMS", per_index)
    items, docs = made()
    indexes = m.build_indexes(spark.createDataFrame(items, "item_id long, text string"))
    assert len(indexes) == (1 if per_index > 100 else 3)
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    got = {r["doc_id"]: {x["item"]: x["score"] for x in r["items"]} for r in m.find_contaminated(df, indexes).collect()}
    assert any(got.values())
    for i, text in enumerate(docs):
        want = slow_search(items, text)
        assert got[i].keys() == want.keys() and all(got[i][k] == pytest.approx(want[k]) for k in want)


def test_table(spark):
    items, docs = made()
    indexes = m.build_indexes(spark.createDataFrame(items, "item_id long, text string"))
    held = items[3][1]
    rows = [(1, held, "x"), (1, held, "x"), (None, None, None), (2, "", ""), (3, "clean text", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, items string").selectExpr("*", "1 AS id", "2 AS contaminated", "3 AS row")
    kept = m.drop_contaminated(df, indexes)
    assert kept.columns == df.columns and sorted((r["doc_id"] for r in kept.collect()), key=str) == [2, 3, None]
    assert m.find_contaminated(df.limit(0), indexes).collect() == []
    none = m.build_indexes(spark.createDataFrame([], "item_id long, text string"))
    assert not any(r["contaminated"] for r in m.find_contaminated(df, none).collect())


def test_query_finds_the_planted_items(spark):
    from millrace.llm.queries import QUERIES
    folder = "/root/testdata/sf0.01"
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    found = {r["doc_id"]: set(r["item_ids"]) for r in QUERIES["op9_decontamination"](spark, folder).collect()}
    planted = 0
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        exact = {i for i, t in items if t in (r["text"] or "")}
        planted += len(exact)
        assert exact <= found[r["doc_id"]]
    assert planted and sum(map(bool, found.values())) <= planted + 5
