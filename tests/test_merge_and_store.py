"""Merging rules, the batch log and streams on top of it."""

from datetime import date, datetime

from pyspark.sql import functions as F

from millrace.meta import watermarks
from millrace.meta.runs import finish
from millrace.operators.merge import incremental_refresh, insert_absent, lookback_start, replace_by_key, upsert
from millrace.sources.feeds import feed_over, sample
from millrace.sources.batches import BatchLog
from millrace.streaming.changes import (STATE, apply_changes, change_state, collect_changes, console_preview, file_stream,
                                        first_deliveries, live_rows, load_topics, newest_state, run_to_end)


def frame(spark, data, schema="k string, a int, b int"):
    return spark.createDataFrame(data, schema)


def test_upsert_touches_only_update_columns_and_matches_null_keys(spark, rows):
    target = frame(spark, [("x", 1, 1), (None, 2, 2), ("y", 3, 3)])
    delta = frame(spark, [("x", 10), (None, 20), ("z", 30)], "k string, a int")
    assert rows(upsert(target, delta, ["k"])) == [("x", 10, 1), ("y", 3, 3), ("z", 30, None), (None, 20, 2)]
    assert rows(upsert(target, delta, ["k"], update=[])) == [
        ("x", 1, 1), ("y", 3, 3), ("z", 30, None), (None, 2, 2)]


def test_upsert_with_empty_delta_and_null_values(spark, rows):
    target = frame(spark, [("x", 1, 1)])
    assert rows(upsert(target, target.limit(0), ["k"])) == [("x", 1, 1)]
    assert rows(upsert(target, frame(spark, [("x", None, 5)]), ["k"])) == [("x", None, 5)]


def test_upsert_adds_new_columns(spark, rows):
    delta = frame(spark, [("x", 7), ("n", 8)], "k string, c int")
    assert rows(upsert(frame(spark, [("x", 1, 1), ("y", 2, 2)]), delta, ["k"])) == [
        ("n", None, None, 8), ("x", 1, 1, 7), ("y", 2, 2, None)]


def test_insert_absent_and_replace_by_key(spark, rows):
    target = frame(spark, [("x", 1, 1), (None, 2, 2)])
    delta = frame(spark, [("x", 9, 9), (None, 9, 9), ("n", 5, 5), ("n", 5, 5)])
    assert rows(insert_absent(target, delta, ["k"])) == [("n", 5, 5), ("x", 1, 1), (None, 2, 2)]
    assert rows(replace_by_key(target, delta, ["k"])) == [
        ("n", 5, 5), ("n", 5, 5), ("x", 9, 9), (None, 9, 9)]


def test_lookback(spark, rows):
    full = frame(spark, [(date(2024, 1, d), "e", d) for d in range(1, 21)], "d date, c string, n int")
    old = full.filter("n <= 15").withColumn("n", F.lit(0))
    after = {r["d"].day: r["n"] for r in incremental_refresh(old, full, ["d", "c"], "d", 7).collect()}
    assert all(after[d] == (0 if d < 8 else d) for d in range(1, 21))
    assert lookback_start(None, "d", 7) == lookback_start(full.limit(0), "d", 7) == datetime(1970, 1, 1)


def test_batches_replace_themselves(spark, rows, tmp_path):
    log = BatchLog(spark, str(tmp_path / "t"), "k string, a int, b int")
    assert log.read().count() == 0 and log.last_batch() == -1
    log.put(frame(spark, [("x", 1, 1), ("y", 2, 2)]), 0)
    log.put(frame(spark, [("x", 1, 1), ("z", 9, 9)]), 1)
    log.put(frame(spark, [("x", 1, 1), ("z", 3, 3)]), 1)
    again = BatchLog(spark, str(tmp_path / "t"), "k string, a int, b int")
    assert rows(again.read()) == [("x", 1, 1), ("x", 1, 1), ("y", 2, 2), ("z", 3, 3)] and again.last_batch() == 1
    assert rows(first_deliveries(again, ["k"])) == [("x", 1, 1), ("y", 2, 2), ("z", 3, 3)]
    small = log.compacted(str(tmp_path / "u"), lambda df: df.distinct())
    assert rows(small.read()) == [("x", 1, 1), ("y", 2, 2), ("z", 3, 3)]


ROW = "user_id bigint, state string, value decimal(12,2)"


def test_changes_apply_in_any_order(spark, rows):
    messages = [("t", 0, i, f'{{"before":null,"after":{{"user_id":1,"state":"s{i}","value":1}},"op":"u","ts_ms":{i}}}')
                for i in range(5)]
    messages.append(("t", 0, 9, '{"before":{"user_id":1},"after":null,"op":"d","ts_ms":9}'))
    messages.append(("t", 0, 10, "not json"))
    df = spark.createDataFrame(messages, "topic string, partition int, offset bigint, value string")
    one = change_state(df.filter("offset >= 3"), ROW, ["user_id"])
    both = apply_changes(one, change_state(df.filter("offset < 3"), ROW, ["user_id"]), ["user_id"])
    assert live_rows(both).count() == 0 and both.count() == 1
    assert rows(live_rows(change_state(df.filter("offset < 5"), ROW, ["user_id"])))[0][:2] == (1, "s4")


def test_stream_restarts_from_its_checkpoint(spark, rows, tmp_path):
    events = sample(spark, "/root/testdata/sf0.001", "events")
    inbox, base = str(tmp_path / "in"), str(tmp_path)
    table = BatchLog(spark, f"{base}/t", f"{ROW}, {STATE}")
    def advance():
        stream = file_stream(spark, inbox, events.schema, 1)
        collect_changes(feed_over(stream, "change_messages", "events"), table, ROW, ["user_id"], f"{base}/ckpt")
    events.filter("event_id >= 500").write.mode("append").parquet(inbox)
    advance()
    events.filter("event_id < 500").write.mode("append").parquet(inbox)
    advance()
    advance()
    whole = change_state(feed_over(events, "change_messages", "events"), ROW, ["user_id"])
    assert rows(newest_state(table.read(), ["user_id"]).select(*whole.columns)) == rows(whole)


def test_console_projection_and_batch_hook(spark, tmp_path):
    events = sample(spark, "/root/testdata/sf0.001", "events")
    stream = feed_over(file_stream(spark, "/root/testdata/sf0.001/events.parquet", events.schema),
                       "change_messages", "events")
    console_preview(stream, str(tmp_path / "a"), sink="memory", name="shown").awaitTermination()
    assert spark.table("shown").columns == ["topic", "partition", "offset", "timestamp", "value_json"]
    counted = []
    run_to_end(stream, str(tmp_path / "b"), lambda df, batch_id: counted.append(df.count()))
    assert sum(counted) == spark.table("shown").count() == events.count()


def test_topics_may_fail_up_to_a_limit():
    def broken():
        raise OSError("down")
    loaded, errors = load_topics({"a": lambda: 3, "b": broken})
    assert loaded == {"a": 3} and list(errors) == ["b"]
    try:
        load_topics({"a": lambda: 3, "b": broken}, min_success=2)
    except RuntimeError as problem:
        assert "1 of 2" in str(problem)
    else:
        raise AssertionError


def test_watermarks(spark):
    at = datetime(2024, 1, 1)
    table = spark.createDataFrame([], watermarks.SCHEMA)
    assert watermarks.get_watermark(table, "p") == watermarks.FALLBACK
    assert watermarks.get_offsets(table, "p") == {}
    table = watermarks.set_watermarks(table, watermarks.watermark_row(spark, "p", "x", at, 5))
    table = watermarks.set_watermarks(table, watermarks.watermark_row(
        spark, "p", watermarks.offsets_text({1: 7, 0: 3}), at, 6, "note"))
    assert table.count() == 1 and watermarks.get_offsets(table, "p") == {0: 3, 1: 7}


def test_run_log_merges_payloads(spark):
    schema = ("run_id string, status string, finished_at timestamp, rows_in bigint, rows_out bigint, "
              "rows_quarantined bigint, error_message string, payload string")
    started = spark.createDataFrame([("r", "running", None, None, None, None, None, '{"a": 1, "b": {"c": 2}}'),
                                     ("s", "running", None, None, None, None, None, None)], schema)
    ended = spark.createDataFrame([("r", "failed", datetime(2024, 1, 1), 1, 2, 3, "boom", '{"a": "x"}')], schema)
    done = {r["run_id"]: r for r in finish(started, ended).collect()}
    assert done["r"]["payload"] == '{"a":"x","b":{"c":2}}' or done["r"]["payload"] == '{"b":{"c":2},"a":"x"}'
    assert done["r"]["status"] == "failed" and done["s"]["status"] == "running"
