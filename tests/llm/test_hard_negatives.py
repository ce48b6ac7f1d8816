import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, score string"
NOT_A_NUMBER = float("nan")


def slow_mine(rows, k=5):
    took = [(i, [math.floor(256 * float(np.float32(x))) for x in v], l) for i, v, l, *_ in rows
            if l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: (-r[0], r[1] is None, r[1] or 0, r[2])
    out = []
    for n, (i, v, l) in enumerate(took):
        if i is None or i % 100:
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), j, m, lj) for m, (j, w, lj) in enumerate(took) if m != n]
        for s, j, _, _ in sorted((x for x in scored if x[3] == l), key=key)[:k]:
            fit = sorted((x for x in scored if x[3] != l and 80 * s <= 100 * x[0] <= 100 * s), key=key)[:k]
            out += [(i, j, r, x[1], s, x[0]) for r, x in enumerate(fit, 1)]
    return sorted(out, key=str)


def fast_mine(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted((tuple(r) for r in hn.mine(df, F.col("vec_id") % 100 == 0, **kw).collect()), key=str)


@pytest.fixture
def small(monkeypatch):
    for name, value in (("CELL_ROWS", 40), ("TASK_ANCHORS", 3), ("LEAF", 4), ("FAN_OUT", 4), ("MAX_PIVOTS", 6)):
        monkeypatch.setattr(hn, name, value)


def test_equals_brute_force(spark, small):
    """Clusters, a hot spot of a third of all rows, ties, repeated ids and rows, nulls, other lengths."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(5, 6))
    rows = [(i, (centres[i % 5] + 0.3 * rng.normal(size=6)).tolist(), int(rng.integers(3)), "x") for i in range(1, 160)]
    rows += [(i * 50, centres[0].tolist(), i % 3, "x") for i in range(80)]
    rows += [(100, centres[1].tolist(), 1, "x")] * 2 + [(200, [0.0] * 6, 1, "x"), (300, [], 1, "x"), (301, [1.0, 2.0], 2, "x"), (None, centres[2].tolist(), 0, "x")]
    rows += [(400, None, 1, "x"), (500, centres[0].tolist(), None, "x"), (600, [1.0, None], 1, "x"), (700, [NOT_A_NUMBER], 1, "x"), (800, [float("inf")], 1, "x")]
    want = slow_mine(rows)
    assert len(want) > 500 and fast_mine(spark, rows) == want


def test_empty_and_lone_rows(spark):
    assert fast_mine(spark, []) == [] and fast_mine(spark, [(100, [1.0, 2.0], 1, "x")]) == []
    assert fast_mine(spark, [(100, [1.0, 0.0], 1, "x"), (1, [0.5, 0.0], 1, "x"), (2, [0.45, 0.1], 2, "x")]) == [(100, 1, 1, 2, 256 * 128, 256 * 115)]


def test_bounds_hold_and_nodes_are_skipped():
    rng = np.random.default_rng(2)
    x = np.floor(256 * np.concatenate([c + 0.05 * rng.normal(size=(200, 8)) for c in rng.normal(size=(6, 8))]))
    hn.LEAF, usual = 16, hn.LEAF
    tree = hn.build_tree(x)
    hn.LEAF = usual
    y, length = x[tree["order"]], float(np.sqrt((x ** 2).sum(axis=1).max()))
    q = np.floor(256 * rng.normal(size=(20, 8)))
    low, high = hn.bounds(q, y[tree["centre"]], tree["radius"], length)
    for node, (a, b) in enumerate(zip(tree["first"], tree["last"])):
        s = q @ y[a:b].T
        assert (s >= low[:, node:node + 1]).all() and (s <= high[:, node:node + 1]).all()
    leaves = tree["children"] == 0
    assert (tree["last"] - tree["first"])[leaves].sum() == len(x)
    parents = np.repeat(np.arange(len(leaves)), tree["children"])
    assert (tree["radius"][1:] <= 2 * tree["radius"][parents] + 1e-9).all()
    verified = []
    cell = hn.Cell({"nos": pa.array([list(range(len(y)))]), "ids": pa.array([list(range(len(y)))]), "labels": pa.array([[0] * len(y)]), "vectors": pa.array([y.ravel().tolist()]),
                    **{c: pa.array([tree[c].tolist()]) for c in ("centre", "radius", "first", "last", "child", "children")}})
    exact = hn.scores
    hn.scores = lambda q, rows: verified.append(len(rows)) or exact(q, rows)
    one = np.zeros(1, np.int64)
    try:
        place, score = cell.search(y[7:8], one - 1, one, True, one, one + hn.LOWEST, one + hn.HIGHEST, 5)
        window = cell.search(y[7:8], one - 1, one, True, one, one - 10 ** 6, one - 10 ** 5, 3)[1]
    finally:
        hn.scores = exact
    every = np.sort((y @ y[7]).astype(int))[::-1]
    assert score[0].tolist() == every[:5].tolist() and window[0].tolist() == every[every <= -10 ** 5][:3].tolist()
    assert sum(verified) < len(y)


def test_exact_beyond_doubles():
    x = np.array([[2.0 ** 30, 1.0]])
    assert hn.scores(np.array([[2.0 ** 30, 1.0]]), x).tolist() == [[2 ** 60 + 1]]
    with pytest.raises(ValueError, match="long"):
        hn.scores(x * 8, np.array([[2.0 ** 32, 1.0]]))
