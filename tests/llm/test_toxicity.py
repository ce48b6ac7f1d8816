import random

import numpy as np
import pytest

from millrace.llm import toxicity as m


def made(seed=0, n=300):
    r = random.Random(seed)
    vocabulary = {f"t{i}": i for i in range(12)}
    idf = np.array([1 + i / 7 for i in range(12)])
    examples = [(i, r.randint(0, 1), r.choices(list(vocabulary), k=r.randint(1, 9))) for i in range(n)]
    vectors = [m.vector(vocabulary, idf, words) for *_, words in examples]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t, _ in vectors])])
    terms, weights = (np.concatenate(x) for x in zip(*vectors))
    return vocabulary, idf, examples, m.build_index(vocabulary, idf, [e[0] for e in examples], np.array([e[1] for e in examples]), offsets, terms, weights, 0.3)


@pytest.mark.parametrize("block", [1, 4, 64])
def test_neighbours_equal_brute_force(monkeypatch, block):
    monkeypatch.setattr(m, "BLOCK", block)
    vocabulary, idf, examples, index = made()
    dense = np.zeros((len(examples), 12))
    for i, (_, _, words) in enumerate(examples):
        t, w = m.vector(vocabulary, idf, words)
        dense[i, t] = w
    r = random.Random(5)
    for _ in range(200):
        t, w = m.vector(vocabulary, idf, r.choices(list(vocabulary) + ["no"], k=r.randint(0, 6)))
        query = np.zeros(12)
        query[t] = w
        cosine = np.rint(dense @ query * 1e9).astype(np.int64)
        want = sorted((-c, i) for i, c in enumerate(cosine.tolist()) if c > 0)[:10]
        assert [(i, c) for i, c in m.nearest(index, t, w, 10)] == [(i, -c / 1e9) for c, i in want]


def test_vote():
    *_, index = made()
    index.labels[:2] = (1, 0)
    assert m.vote(index, []) == pytest.approx(0.3)
    assert m.vote(index, [(0, 0.9), (1, 0.1)]) == pytest.approx((0.9 + 0.3 * m.PRIOR_WEIGHT) / (1.0 + m.PRIOR_WEIGHT))


def test_terms():
    assert m.terms_of(["abcdef", "abcd"] * 2) == {"abcdef": 2, "abcd": 2, "^abcd": 4, "^abcde": 2, "^abcdef": 2, "^abcd/2": 1, "^abcd/4": 1, "^abcde/2": 1, "^abcdef/2": 1}


def test_table(spark):
    r = random.Random(2)
    words = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(400):
        text, bad = r.choices(words, k=20), i % 4 == 0
        if bad:
            text.insert(3, r.choice(["scum", "moron"]))
        rows.append((i, " ".join(text), int(bad)))
    rows += [(None, "moron", None), (900, None, 1), (901, "", 0), (902, "w1", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int").selectExpr("*", "1 AS id", "2 AS score", "3 AS label")
    index = m.learn(df)
    assert set(index.vocabulary) >= {"scum", "moron"}
    docs = spark.createDataFrame([(1, "You MORON, w3", "x"), (1, "You MORON, w3", "x"), (None, None, None), (2, "", ""), (3, "w1 w2 " * 30000, "")], "doc_id long, text string, predicted string").selectExpr("*", "1 AS id")
    got = m.score_texts(docs, index).collect()
    assert sorted(((x["doc_id"], x["predicted"]) for x in got), key=str) == sorted([(1, 1), (1, 1), (None, 0), (2, 0), (3, 0)], key=str)
    assert all(0 <= x["score"] <= 1 for x in got) and all(len(x["evidence"]) == m.NEIGHBOURS for x in got if x["doc_id"] == 1)
    assert m.score_texts(docs.limit(0), index).collect() == []
    nothing = m.learn(df.limit(0))
    assert {x["score"] for x in m.score_texts(docs, nothing).collect()} == {0.0}


def test_held_out_accuracy(spark):
    from millrace.llm.queries import QUERIES
    folder = "/root/testdata/sf0.1"
    found = QUERIES["op2_toxicity"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").filter("held_out").select("toxic", "predicted", "score").collect()
    toxic = [x for x in found if x["toxic"]]
    clean = [x for x in found if not x["toxic"]]
    assert sum(x["predicted"] for x in toxic) > 0.8 * len(toxic)
    assert sum(x["predicted"] for x in clean) < 0.02 * len(clean)
    # Calibration: the mean score is close to the share of toxic rows.
    assert abs(np.mean([x["score"] for x in found]) - len(toxic) / len(found)) < 0.1
