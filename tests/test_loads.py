"""Vault tables kept by loads, and landing folders."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.operators.keys import HubSpec, LinkSpec
from millrace.operators.pit import build_pit
from millrace.operators.scd2 import SatSpec, build_satellite
from millrace.plans.loads import PitTable, SatelliteTable, VaultTable
from millrace.sources.landing import Prefix, load_prefix, new_logs, newest_manifest

NOW = datetime(2024, 5, 1)
SAT = SatSpec("s", "src", ("value",), single_version=True)


def observations(spark, seed):
    r = random.Random(seed)
    rows = [(f"k{r.randint(0, 4)}", r.choice("abc"), NOW + timedelta(days=r.randint(0, 3)), NOW + timedelta(hours=r.randint(0, 60)), "src", i)
            for i in range(120)]
    return spark.createDataFrame(rows, "hub_key string, hashdiff string, load_dts timestamp, effective_from timestamp, record_source string, value int")


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 0, 1)])
def test_satellite_does_not_depend_on_the_order_of_loads(spark, rows, tmp_path, order):
    whole = observations(spark, 7)
    table = SatelliteTable(spark, str(tmp_path / "s"), SAT, buckets=3)
    for number in (*order, order[0]):
        table.load(whole.filter(f"value % 3 = {number}"), number)
    want = build_satellite(whole, SatSpec("s", "src", ("value",)))
    keys = ["hub_key", "hashdiff", "effective_from", "effective_to", "is_current"]
    assert rows(table.rows().select(*keys)) == rows(want.select(*keys))


def test_keys_are_appended_once(spark, rows, tmp_path):
    schema = "a string, b string, load_dts timestamp, record_source string"
    first = spark.createDataFrame([("1", "x", NOW, "s"), ("1", "x", NOW, "s"), (None, "x", NOW, "s")], schema)
    second = spark.createDataFrame([("1", "x", NOW + timedelta(1), "s"), ("2", "x", NOW, "s")], schema)
    hub = VaultTable(spark, str(tmp_path / "h"), HubSpec("h", "src", "a"))
    link = VaultTable(spark, str(tmp_path / "l"), LinkSpec("l", "src", (("a", "a"), ("b", "b"))))
    with pytest.raises(ValueError):
        hub.rows()
    for table in (hub, link):
        for number, frame in ((1, first), (2, second), (2, second), (1, first)):
            table.load(frame, number)
    assert [(k, t) for k, t in rows(hub.rows().select("business_key", "load_dts"))] == [("1", NOW), ("2", NOW)]
    assert link.rows().count() == 2


def test_landing_goes_on_where_it_stopped(spark, rows, tmp_path):
    folder, stored = tmp_path / "in", []
    folder.mkdir()
    (folder / "a.jsonl").write_text('{"k": 1}\nbroken\n\n{"k": 2}\n')
    (folder / "b.xyz").write_text("what")
    (folder / "c.csv").write_text("k\n3\n")
    manifest, quarantine = new_logs(spark, str(tmp_path / "logs"))
    prefix = Prefix(str(folder), "k int")

    def run(limit=None):
        return load_prefix(spark, prefix, manifest, quarantine, lambda df, n: stored.append((n, df.count())), NOW, limit)
    assert run(1) == 1 and run() == 2 and run() == 0
    (folder / "d.csv").write_text("k\n4\n5\n")
    assert run() == 1
    got = {r["file_path"].rsplit("/", 1)[1]: (r["status"], r["rows_loaded"], r["error"]) for r in newest_manifest(manifest).collect()}
    assert got == {"a.jsonl": ("loaded", 2, None), "b.xyz": ("quarantined", None, "unsupported file format"), "c.csv": ("loaded", 1, None), "d.csv": ("loaded", 2, None)}
    assert [r["line"] for r in quarantine.read().collect()] == ["broken"]
    assert stored == [(0, 2), (1, 1), (2, 2)]


PLAIN = SatSpec("s", "src", ("value",))
COLUMNS = "hub_key string, hashdiff string, load_dts timestamp, effective_from timestamp, record_source string, value int"


def seen_at(spark, *rows):
    return spark.createDataFrame([(k, h, NOW, NOW + timedelta(days=d), "src", 1) for k, h, d in rows], COLUMNS)


def test_a_load_leaves_buckets_without_a_known_hub_as_they_are(spark, rows, tmp_path):
    table = SatelliteTable(spark, str(tmp_path / "s"), PLAIN, buckets=1)
    files = lambda: {p: p.stat().st_mtime_ns for p in (tmp_path / "s" / "timeline").glob("bucket=*/*.parquet")}
    first, new = seen_at(spark, ("a", "x", 0), ("a", "y", 2), ("b", "x", 1)), seen_at(spark, ("c", "x", 0), ("c", "x", 1), ("c", "y", 3))
    assert rows(table.load(first)) == [("a", NOW.date()), ("b", (NOW + timedelta(1)).date())]
    written = files()
    assert table.load(first).isEmpty() and files() == written
    assert rows(table.load(new)) == [("c", NOW.date())]
    assert written.items() < files().items()
    assert rows(table.rows()) == rows(build_satellite(first.union(new), PLAIN))
    table.load(seen_at(spark, ("a", "z", 1)))
    assert not written.keys() & files().keys()
    assert rows(table.rows()) == rows(build_satellite(first.union(new).union(seen_at(spark, ("a", "z", 1))), PLAIN))


@pytest.mark.parametrize("step", ["append", "replace_all"])
def test_a_load_takes_up_what_a_broken_one_left(spark, rows, tmp_path, monkeypatch, step):
    table = SatelliteTable(spark, str(tmp_path / "s"), PLAIN, buckets=1)
    first, more = seen_at(spark, ("a", "x", 0)), seen_at(spark, ("b" if step == "append" else "a", "y", 2))
    table.load(first)
    with monkeypatch.context() as m:
        def broken(*_):
            raise OSError("gone")
        m.setattr(table._tables[1], step, broken)
        with pytest.raises(OSError):
            table.load(more)
    other = SatelliteTable(spark, str(tmp_path / "s"), PLAIN, buckets=1)
    assert rows(other.load(seen_at(spark, ("c", "x", 0)))) == [("b" if step == "append" else "a", (NOW + timedelta(2)).date()), ("c", NOW.date())]
    assert rows(other.rows()) == rows(build_satellite(first.union(more).union(seen_at(spark, ("c", "x", 0))), PLAIN))
    assert other.load(more).isEmpty()


def test_kept_days_are_stored_as_runs(spark, rows, tmp_path):
    sat = SatelliteTable(spark, str(tmp_path / "s"), PLAIN, buckets=2)
    pit = PitTable(spark, str(tmp_path / "p"), [("s", sat)], 100)
    whole = seen_at(spark, ("a", "x", -50), ("a", "y", -10), ("b", "x", -200))
    hub = spark.createDataFrame([("a",), ("b",), ("none",)], "hub_key string")
    pit.refresh(sat.load(whole), hub, NOW.date())
    assert pit.table.read().count() == 5 and pit.rows().count() == 303
    late = seen_at(spark, ("a", "z", -30))
    pit.refresh(sat.load(late), hub, (NOW + timedelta(2)).date())
    want = build_pit(hub, [("s", build_satellite(whole.union(late), PLAIN))], (NOW + timedelta(2)).date(), 100)
    assert rows(pit.rows()) == rows(want)
    assert rows(pit.rows(F.upper)) == rows(want.withColumn("hub_key", F.upper("hub_key")))


def test_runs_of_two_satellites_are_cut_where_either_changes(spark, rows):
    r = random.Random(3)
    sats = [build_satellite(seen_at(spark, *[(f"k{r.randint(0, 5)}", r.choice("abc"), r.randint(-15, 2)) for _ in range(40)]), PLAIN) for _ in range(2)]
    hub = spark.createDataFrame([(f"k{i}",) for i in range(7)], "hub_key string")
    got = build_pit(hub, [("p", sats[0]), ("q", sats[1])], NOW.date(), 12)
    versions = [[tuple(x) for x in s.select("hub_key", "effective_from", "effective_to", "load_dts", "hashdiff").collect()] for s in sats]
    want = []
    for k in range(7):
        for d in range(13):
            day = NOW - timedelta(days=12 - d)
            end, row = day + timedelta(days=1) - timedelta(seconds=1), [f"k{k}", day.date()]
            for v in versions:
                at = [(x[3], x[4], x[1]) for x in v if x[0] == f"k{k}" and x[1] <= end and (x[2] is None or end < x[2])]
                row += at[0] if at else (None, None, None)
            want.append(tuple(row))
    assert rows(got) == sorted(want, key=lambda t: tuple((v is None, str(v)) for v in t))
