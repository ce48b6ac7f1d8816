import random

import numpy as np

from millrace.llm import toxicity as m


def made(spark):
    r = random.Random(4)
    words = [f"w{i}" for i in range(40)]
    docs = [(i, " ".join(r.choices(words, k=12) + (["scum"] * 2 if i % 3 == 0 else []))) for i in range(200)]
    docs += [(7, docs[7][1]), (7, "w1 scum other"), (None, "scum w2"), (500, None), (501, "w3 no label")]
    labels = [(i, int(i % 3 == 0)) for i in range(200)] + [(7, 1), (7, 1), (8, None), (9, 5), (None, 1), (500, 0), (999, 1)]
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_joined_learning_equals_learning_from_the_join(spark):
    docs, labels = made(spark)
    for most in (10, 60, 10_000):
        want = m.learn(docs.join(labels, "doc_id"), max_examples=most)
        got = m.learn_joined(docs, labels, max_examples=most)
        assert got.vocabulary == want.vocabulary and got.ids == want.ids and (got.prior, got.votes) == (want.prior, want.votes)
        for field in ("idf", "rows", "example", "weight", "labels"):
            assert np.array_equal(getattr(got, field), getattr(want, field)), field
    assert m.learn_joined(docs, labels.filter("doc_id > 5000")).ids == []


def test_no_text_is_shuffled(spark, monkeypatch):
    docs, labels = made(spark)
    plans = {}
    kept = m.stored
    monkeypatch.setattr(m, "stored", lambda df, label: plans.setdefault(label, df) is None or kept(df, label))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        m.learn_joined(docs, labels)
        shuffled = [line for df in plans.values() for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line]
        examples = plans["examples"]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert shuffled and "BroadcastHashJoin" in examples and "SortMergeJoin" not in examples and "Exchange hashpartitioning" not in examples
    assert "text" not in plans["labelled-ids"].columns
