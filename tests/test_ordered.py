"""Where segments are cut must not change any result."""

import random
from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.operators.ordered import Series, segmented, unsegmented, with_last_known, with_neighbours, with_running_max

START = datetime(2024, 1, 1)
SCHEMA = "key string, ts timestamp_ntz, id int, value int"


def make(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def skewed(seed, n=400):
    """One key, NULL included, holds half of the rows."""
    rng = random.Random(seed)
    keys = ["hot"] * 5 + [None] * 2 + ["a", "b", "c"]
    return [(rng.choice(keys), START + timedelta(minutes=rng.randint(0, 3000)), i,
             rng.choice([None, rng.randint(0, 50)])) for i in range(n)]


def expected(data):
    out = {}
    for key in {r[0] for r in data}:
        group = sorted((r for r in data if r[0] == key), key=lambda r: (r[1], r[2]))
        known, peak = None, None
        for i, r in enumerate(group):
            known = r[3] if r[3] is not None else known
            before = group[i - 1] if i else None
            after = group[i + 1] if i + 1 < len(group) else None
            out[r[2]] = (before and before[3], after and after[1], known, peak)
            if r[3] is not None:
                peak = r[3] if peak is None else max(peak, r[3])
    return out


def run(df):
    series = Series(("key",), "ts", ("id",))
    df = segmented(df, series)
    df = with_neighbours(df, series, previous={"p": "value"}, following={"n": "ts"})
    df = with_running_max(with_last_known(df, series, "k", "value"), series, "m", "value")
    return {r["id"]: (r["p"], r["n"], r["k"], r["m"]) for r in unsegmented(df).collect()}


@pytest.fixture(params=[1, 7])
def segments(request, spark):
    """So many ranges, none of them put together at run time."""
    asked = {"spark.sql.shuffle.partitions": str(request.param), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in asked}
    for k, v in asked.items():
        spark.conf.set(k, v)
    yield request.param
    for k, v in before.items():
        spark.conf.set(k, v)


def test_segments_equal_brute_force(spark, segments):
    data = skewed(segments)
    assert run(make(spark, data)) == expected(data)


def test_one_key_holds_all_rows(spark, segments):
    data = [("hot", START, i, i * 7 % 31 if i % 50 == 0 else None) for i in range(300)]
    df = make(spark, data)
    assert run(df) == expected(data)
    sizes = [r["count"] for r in segmented(df, Series(("key",), "ts", ("id",))).groupBy("_segment").count().collect()]
    assert len(sizes) == segments and max(sizes) < 3 * len(data) / segments + 10


def test_each_step_alone_keeps_the_columns(spark, segments):
    data, series = skewed(3, 60), Series(("key",), "ts", ("id",))
    df, want = make(spark, data), expected(skewed(3, 60))
    for i, name, out in ((0, "p", with_neighbours(df, series, previous={"p": "value"})), (2, "k", with_last_known(df, series, "k", "value")),
                         (3, "m", with_running_max(df, series, "m", "value"))):
        assert out.columns == [*df.columns, name] and {r["id"]: r[name] for r in out.collect()} == {k: v[i] for k, v in want.items()}


def test_rows_dropped_between_steps_leave_empty_segments(spark, segments):
    data, series = skewed(5), Series(("key",), "ts", ("id",))
    part = [r for r in data if r[2] % 40 == 0]
    kept = segmented(make(spark, data), series).filter("id % 40 = 0")
    got = with_neighbours(kept, series, previous={"p": "value"}, following={"n": "ts"})
    assert {r["id"]: (r["p"], r["n"]) for r in got.collect()} == {k: v[:2] for k, v in expected(part).items()}


def test_empty_table(spark):
    assert run(make(spark, [])) == {}


@settings(max_examples=3, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["x", "y", None]), st.integers(0, 600),
                          st.one_of(st.none(), st.integers(0, 9))), min_size=1, max_size=30))
def test_segments_equal_brute_force_property(spark, drawn):
    data = [(k, START + timedelta(minutes=m), i, v) for i, (k, m, v) in enumerate(drawn)]
    assert run(make(spark, data)) == expected(data)


def test_rows_are_written_once_for_a_chain(spark):
    series = Series(("key",), "ts", ("id",))
    dealt = segmented(make(spark, skewed(3)), series)
    plan = with_running_max(with_neighbours(dealt, series, previous={"p": "value"}), series, "m", "value")._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" not in plan and "LogicalRDD" not in plan
