import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from millrace.llm import maxent_lm as lm
from millrace.llm.queries import op13_maxent_lm

FOLDER = "/root/testdata/sf0.001"


def tokens(text):
    return [*(text or "").encode().lower().split(), b""]


def slow_base(rows, train):
    """n_tokens, n_known, train_tokens and base score by plain counting."""
    counts = Counter(t for i, text in rows if train(i) for t in tokens(text))
    total, kinds = sum(counts.values()), len(counts)
    return [(i, len(tokens(text)), sum(counts[t] > 0 for t in tokens(text)), total,
             math.fsum(math.log10((counts[t] + 0.1) / (total + 0.1 * (kinds + 1))) for t in tokens(text))) for i, text in rows]


def agree(got, want):
    key = lambda r: tuple((x is None, x or 0) for x in r[:3]) + (round(r[4], 4),)
    got, want = sorted(got, key=key), sorted(want, key=key)
    return len(got) == len(want) and all(a[:4] == b[:4] and math.isclose(a[4], b[4], rel_tol=1e-9, abs_tol=1e-6) for a, b in zip(got, want))


def base_of(df):
    return [tuple(r) for r in df.select("doc_id", "n_tokens", "n_known", "train_tokens", "base_score").collect()]


def test_query_equals_slow_base_and_beats_it(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    held_out = lambda i: zlib.crc32(str(i).encode()) % 10 == 0
    got = op13_maxent_lm(spark, FOLDER)
    assert agree(base_of(got), slow_base(rows, lambda i: not held_out(i)))
    assert all(r["held_out"] == held_out(r["doc_id"]) for r in got.collect())
    base, score, n = got.filter("held_out AND n_known > 20").agg(F.sum("base_score"), F.sum("score"), F.sum("n_tokens")).first()
    assert score / n > base / n


def test_rare_words_join(spark, monkeypatch):
    """With few frequent words nearly all words go through the join; nulls, empty and long texts, repeats, clashing names."""
    monkeypatch.setattr(lm, "FREQUENT", 3)
    rows = [(1, "a b  b\tc"), (2, "A B é É"), (3, None), (4, ""), (4, ""), (None, "zzz b"), (5, "unseen words b " * 50_000), (6, "x" * 100_000 + " b"), (7, "\x0b\x1c b")]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, no int, word int").repartition(4)
    train = F.col("doc_id").isNull() | (F.col("doc_id") != 5)
    model, counts = lm.learn(docs, train)
    assert len(model.words) <= 4
    assert agree(base_of(lm.score_texts(docs, model, counts, keep=("no", "word"))), slow_base(rows, lambda i: i != 5))


def test_empty_table_and_nothing_learned(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    model, counts = lm.learn(docs.limit(0), F.lit(True))
    assert lm.score_texts(docs.limit(0), model, counts).count() == 0
    got = {r["doc_id"]: r for r in lm.score_texts(docs, model, counts).collect()}
    assert (got[1]["n_tokens"], got[1]["n_known"], got[1]["train_tokens"], got[1]["base_score"]) == (3, 0, 0, 0.0)
    assert math.isclose(got[1]["score"], 3 * math.log10(1 / (lm.CLASSES * lm.MEMBERS)), rel_tol=1e-5)


def _trained():
    texts = [b"the cat sat on the mat", b"the dog sat on the log", b"a cat and a dog sat"] * 30
    counts = Counter(w for t in texts for w in [*lm.words_of(t), lm.END])
    words = sorted(counts, key=lambda w: (-counts[w], w))
    kept = words[:6]
    shared, kinds = np.zeros(lm.SHARED), np.zeros(lm.SHARED)
    for w in words[6:]:
        shared[zlib.crc32(w) % lm.SHARED] += counts[w]
        kinds[zlib.crc32(w) % lm.SHARED] += 1
    model = lm.Model(kept, np.array([counts[w] for w in kept]), shared, kinds, sum(counts.values()), len(counts), lm.empty_tables()).prepare()
    tables = [[w, q, np.zeros(len(w), np.float32)] for w, q in model.tables]
    for _ in range(20):
        lm.train_on(model, tables, texts)
    return model, counts, texts


def test_probabilities_of_all_words_and_the_unseen_sum_to_one():
    model, counts, _ = _trained()
    ids, at, _, _ = lm.token_ids(model.ids, [b"the cat"])
    here = at[2:3]
    every = np.arange(lm.CLASSES * lm.MEMBERS)
    by_symbol = 10 ** lm.symbol_logs(model, np.repeat(ids[None, :], len(every), 0).ravel(), here[0] + np.arange(len(every)) * len(ids), every)
    assert math.isclose(by_symbol.sum(), 1, rel_tol=1e-4)
    inside = np.zeros(lm.SHARED)
    for w, c in counts.items():
        if w not in model.words:
            inside[zlib.crc32(w) % lm.SHARED] += (c + 0.1) / 10 ** model.shared_log[zlib.crc32(w) % lm.SHARED]
    assert (inside + 0.1 / 10 ** model.shared_log <= 1 + 1e-9).all()


def test_history_matters():
    model, _, _ = _trained()
    ids, at, _, _ = lm.token_ids(model.ids, [b"sat on the", b"the on sat"])
    logs = lm.symbol_logs(model, ids, at, lm.symbols_of(model, ids[at]))
    assert logs[:3].sum() > logs[4:7].sum() + 1


def test_sums_of_runs():
    rng = np.random.default_rng(0)
    for n in (1, 5, 300):
        values, start = rng.normal(size=(n, 3)), np.unique(np.concatenate([[0], rng.integers(0, n, n // 4)]))
        size = np.diff(np.append(start, n))
        order = np.argsort(-size, kind="stable")
        assert np.allclose(lm._sums(values, start[order], size[order]), np.add.reduceat(values, start, axis=0)[order])
