"""Hand-made cases of hashing, hubs, versions, timelines and point-in-time tables."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.functions.hashing import canonical_json, hash_columns
from millrace.operators.keys import HubSpec, LinkSpec, hub_rows, link_rows
from millrace.operators.pit import build_pit, date_spine
from millrace.operators.scd2 import (SatSpec, build_satellite, close_and_insert, load_satellite, lossless_timeline,
                                     new_versions)
from millrace.quality.checks import wrong_current
from millrace.quality.invariants import gaps, overlaps

SPEC = SatSpec("sat", "src", ("payload",))
SCHEMA = ("hub_key string, hashdiff string, load_dts timestamp_ntz, effective_from timestamp_ntz, "
          "record_source string, payload string")
DAY = datetime(2024, 1, 1)


def at(n):
    return DAY + timedelta(days=n)


def source(spark, versions):
    """versions: (hub, hash, effective day[, load day])"""
    data = [(v[0], v[1], at(v[3] if len(v) > 3 else v[2]), None if v[2] is None else at(v[2]), "s", v[1])
            for v in versions]
    return spark.createDataFrame(data, SCHEMA)


def chain(df):
    """(hub, hash, from day, to day, current) in order"""
    def day(t):
        return None if t is None else (t - DAY).total_seconds() / 86400
    return sorted([(r["hub_key"], r["hashdiff"], day(r["effective_from"]), day(r["effective_to"]), r["is_current"])
                   for r in df.collect()], key=lambda t: (t[0], t[2]))


def hashes(df):
    return [c[1] for c in chain(df)]


def test_hash_normalises_blank_case_and_null(spark):
    df = spark.createDataFrame([(" Ab ", "x"), ("AB", "x"), ("", "x"), (None, "x"), ("^^", "x"), ("x", "ab")],
                               "a string, b string")
    h = [r[0] for r in df.select(hash_columns(df, ["a", "b"])).collect()]
    assert h[0] == h[1] and h[2] == h[3] == h[4] and h[0] != h[5] and len(h[0]) == 64


def test_hash_is_order_sensitive_and_collides_on_the_separator(spark):
    df = spark.createDataFrame([("a||b", "c"), ("a", "b||c")], "a string, b string")
    first, second = [r[0] for r in df.select(hash_columns(df, ["a", "b"])).collect()]
    assert first == second
    assert df.select(hash_columns(df, ["b", "a"])).first()[0] != first


def test_canonical_json_sorts_keys(spark):
    df = spark.createDataFrame([('{"b": 1, "a": {"d": 2, "c": [1,  2]}}',), ("no json",), (None,)], "j string")
    assert [r[0] for r in df.select(canonical_json(F.col("j"))).collect()] == [
        '{"a":{"c":[1,2],"d":2},"b":1}', "no json", None]


def test_hub_and_link_insert_only_new_keys(spark):
    src = spark.createDataFrame([("1", "7", at(2), "b"), ("1", "7", at(1), "c"), ("2", None, at(0), "a"),
                                 (None, "7", at(0), "a")], "a string, b string, load_dts timestamp_ntz, record_source string")
    spec = HubSpec("hub", "src", "a")
    hub = hub_rows(src, spec)
    assert sorted((r["business_key"], r["load_dts"], r["record_source"]) for r in hub.collect()) == [
        ("1", at(1), "b"), ("2", at(0), "a")]
    assert hub_rows(src, spec, existing=hub).count() == 0
    link = LinkSpec("l", "src", (("a", "a"), ("b", "b")))
    assert link_rows(src, link).count() == 1
    assert link_rows(src, link, existing=link_rows(src, link)).count() == 0


def test_first_load_keeps_latest_load_then_smallest_hash_and_drops_incomplete(spark):
    src = source(spark, [("h", "A", 1, 5), ("h", "B", 1, 6), ("h", "C", 1, 6), (None, "X", 1), ("h", "Y", None, 1)])
    assert chain(build_satellite(src, SPEC)) == [("h", "B", 1, None, True)]


def test_runs_collapse(spark):
    src = source(spark, [("h", x, i) for i, x in enumerate("AABBA")])
    assert chain(build_satellite(src, SPEC)) == [
        ("h", "A", 0, 2, False), ("h", "B", 2, 4, False), ("h", "A", 4, None, True)]


LATE = {  # hub: (late versions, hashes afterwards)
    "same-instant-same-hash": ([("A", 1)], "AB"),
    "same-instant-new-hash": ([("C", 1)], "AB"),
    "before-the-first": ([("Z", 0)], "ZAB"),
    "between": ([("C", 2)], "ACB"),
    "equal-to-previous": ([("A", 2)], "AB"),
    "equal-to-next": ([("B", 2)], "AB"),
    "repeats-the-newest": ([("B", 9)], "AB"),
    "untouched": ([], "AB"),
}


def test_second_load_with_late_rows(spark):
    target = build_satellite(source(spark, [(h, x, d) for h in LATE for x, d in (("A", 1), ("B", 3))]), SPEC)
    late = [(h, x, d) for h, (versions, _) in LATE.items() for x, d in versions] + [("new", "A", 0)]
    after = load_satellite(target, source(spark, late), SPEC)
    found = chain(after)
    by_hub = {h: "".join(v[1] for v in found if v[0] == h) for h in (*LATE, "new")}
    assert by_hub == {**{h: want for h, (_, want) in LATE.items()}, "new": "A"}
    assert [v[2] for v in found if v[0] == "equal-to-next"] == [1, 2]
    assert gaps(after).count() == overlaps(after).count() == wrong_current(after, mode="exactly_one").count() == 0


def test_batch_rows_are_compared_with_the_target_only(spark):
    target = build_satellite(source(spark, [("h", "A", 1)]), SPEC)
    delta = new_versions(source(spark, [("h", "B", 2), ("h", "B", 3), ("h", "A", 4)]), target, SPEC)
    assert sorted(r["hashdiff"] for r in delta.collect()) == ["B", "B"]


def test_collapsed_observation_is_lost_unless_lossless(spark):
    first, late = source(spark, [("h", "A", 1), ("h", "A", 3)]), source(spark, [("h", "B", 2)])
    assert hashes(load_satellite(build_satellite(first, SPEC), late, SPEC)) == ["A", "B"]
    assert hashes(lossless_timeline(first.unionByName(late), SPEC)) == ["A", "B", "A"]


def random_log(seed, n=120):
    rng = random.Random(seed)
    keys = ["hot"] * 6 + ["a", "b", "c"]
    seen, out = set(), []
    for _ in range(n):
        v = (rng.choice(keys), rng.choice("ABC"), rng.randint(0, 2000) / 24)
        if (v[0], v[2]) not in seen:
            seen.add((v[0], v[2]))
            out.append(v)
    return out


def test_in_order_increments_equal_full_build(spark):
    """One observation per key and load, as staging delivers them."""
    log = sorted(random_log(5, 40), key=lambda v: v[2])
    turn = {}
    batches = {}
    for v in log:
        turn[v[0]] = turn.get(v[0], 0) + 1
        batches.setdefault(min(turn[v[0]], 3), []).append(v)
    log = [v for n in (1, 2) for v in batches[n]] + list({v[0]: v for v in reversed(batches[3])}.values())
    target = build_satellite(source(spark, batches[1]), SPEC)
    for batch in (batches[2], [v for v in log if v in batches[3]]):
        target = load_satellite(target, source(spark, batch), SPEC)
    assert chain(target) == chain(build_satellite(source(spark, log), SPEC))


@pytest.mark.parametrize("segments", [1, 9])
def test_late_loads_keep_the_invariants_however_segments_are_cut(spark, segments):
    log = random_log(6)
    plain = chain(load_satellite(build_satellite(source(spark, log[:80]), SPEC), source(spark, log[80:]), SPEC))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(segments))
    try:
        after = load_satellite(build_satellite(source(spark, log[:80]), SPEC), source(spark, log[80:]), SPEC)
        assert chain(after) == plain
        assert gaps(after).count() == overlaps(after).count() == 0
        assert wrong_current(after, mode="exactly_one").count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_close_and_insert_never_leaves_two_current_rows(spark):
    target = build_satellite(source(spark, [("h", "A", 1, 1), ("k", "A", 1, 1)]), SPEC)
    inbox = source(spark, [("h", "B", 1, 2), ("k", "A", 5, 2), ("n", "C", 3, 2)])
    after = close_and_insert(target, inbox, SPEC.columns)
    assert chain(after) == [("h", "B", 1, None, True), ("k", "A", 1, None, True), ("n", "C", 3, None, True)]


def test_pit_sees_changes_up_to_one_second_before_midnight(spark):
    second = timedelta(seconds=1)
    moments = [("in", at(1) + timedelta(days=1) - second), ("out", at(1) + timedelta(days=1) - second + timedelta(microseconds=1)),
               ("two", at(0) + timedelta(hours=1)), ("two", at(0) + timedelta(hours=9))]
    data = [(k, f"v{i}", t, t, "s", "p") for i, (k, t) in enumerate(moments)]
    sat = build_satellite(spark.createDataFrame(data, SCHEMA), SPEC)
    hubs = spark.createDataFrame([("in",), ("out",), ("two",), ("none",)], "hub_key string")
    pit = {(r["hub_key"], r["as_of_date"]): r["s_hashdiff"] for r in build_pit(hubs, [("s", sat)], date(2024, 1, 3), 3).collect()}
    assert len(pit) == 16
    assert pit["in", date(2024, 1, 2)] == "v0" and pit["in", date(2024, 1, 1)] is None
    assert pit["out", date(2024, 1, 2)] is None and pit["out", date(2024, 1, 3)] == "v1"
    assert pit["two", date(2024, 1, 1)] == "v3"
    assert all(pit["none", date(2023, 12, 31) + timedelta(days=i)] is None for i in range(4))


def test_spine_has_both_ends(spark):
    days = [r[0] for r in date_spine(spark, date(2024, 3, 1), 2).collect()]
    assert sorted(days) == [date(2024, 2, 28), date(2024, 2, 29), date(2024, 3, 1)]
