"""Many queries against all stored vectors, held against brute force."""

import numpy as np
import pytest

from millrace.vector import many
from millrace.vector.many import top_k_many


def brute(corpus, queries, k):
    out = []
    for q, a in queries:
        scores = [(-round(float(np.dot(a, b)), 9), i) for i, b in corpus if len(a) == len(b)]
        out += [(q, i, r + 1) for r, (_, i) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def rows(df):
    return sorted((r["query_id"], r["vec_id"], r["rank"]) for r in df.collect())


@pytest.mark.parametrize("part_rows, slice_queries, steps", [(40, 7, 8), (8192, 100_000, 256)])
def test_many_queries_equal_brute_force(spark, monkeypatch, part_rows, slice_queries, steps):
    monkeypatch.setattr(many, "PART_ROWS", part_rows)
    monkeypatch.setattr(many, "SLICE_QUERIES", slice_queries)
    monkeypatch.setattr(many, "STEPS", steps)
    monkeypatch.setattr(many, "PIVOTS", 12)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(9, 6)) * 3
    vectors = (centres[rng.integers(0, 9, 500)] + rng.normal(size=(500, 6)) * 0.2).round(3)
    vectors[100:260] = vectors[7]
    vectors[3] = 0
    corpus = [(i, v.tolist()) for i, v in enumerate(vectors)]
    queries = [(i, v.tolist()) for i, v in enumerate(vectors[::11])] + [(900, [0.0] * 6), (901, [-5.0, 1.0, 0.0, 0.0, 2.0, 1.0])]
    got = top_k_many(spark.createDataFrame(corpus, "vec_id long, embedding array<double>").repartition(5),
                     spark.createDataFrame(queries, "query_id long, embedding array<double>").repartition(3), 6)
    assert rows(got) == brute(corpus, queries, 6)


def test_queries_go_only_to_parts_that_can_hold_neighbours(spark, monkeypatch):
    monkeypatch.setattr(many, "PART_ROWS", 50)
    met = []
    plain = many._meet

    def counted(pairs, *rest):
        met.append(pairs.count())
        return plain(pairs, *rest)

    monkeypatch.setattr(many, "_meet", counted)
    rng = np.random.default_rng(5)
    centres = np.eye(10)
    vectors = centres[np.arange(1000) % 10] + rng.normal(size=(1000, 10)) * 0.01
    corpus = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    queries = corpus.filter("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id")
    got = top_k_many(corpus, queries, 3)
    assert rows(got) == brute(list(enumerate(vectors)), [(i, vectors[i]) for i in range(0, 1000, 20)], 3)
    assert met[0] == 50 and met[1] < 50 * 30


def test_missing_ragged_and_no_vectors(spark):
    nan = float("nan")
    corpus = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [1.0]), (5, []), (None, [9.0, 9.0]), (6, [nan, 1.0]), (2, [0.0, 1.0])],
                                   "vec_id long, embedding array<double>")
    queries = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (2, [1.0, 0.0]), (None, [0.0, 1.0]), (6, None), (7, [2.0]), (8, [1.0, 1.0, 1.0])],
                                    "query_id long, embedding array<double>")
    got = sorted(((r["query_id"], r["vec_id"], r["rank"]) for r in top_k_many(corpus, queries, 2).collect()), key=str)
    assert got == sorted([(1, 1, 1), (1, 2, 2), (2, 2, 1), (2, 2, 2), (2, 1, 1), (2, 2, 2), (None, 2, 1), (None, 2, 2), (7, 4, 1)], key=str)
    assert top_k_many(corpus.limit(0), queries, 2).count() == 0 and top_k_many(corpus, queries.limit(0), 2).count() == 0
