"""Files, messages, contracts, checks, privacy, vectors, training."""

from datetime import date, datetime, timezone
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions.clock import parse_instant, run_slug
from millrace.functions.payloads import extension_rows, order_rows, parse_moment
from millrace.functions.privacy import mask_email, mask_name, resolve_salt
from millrace.functions.text import email_is_valid, identifier_token
from millrace.meta import runs, watermarks
from millrace.meta.runs import recent_results
from millrace.ml.order_value import TrainingSpec, save, train, training_frame
from millrace.operators.contracts import Contract, split, with_violations
from millrace.plans import finance
from millrace.plans.business import payments_per_order
from millrace.plans.marketplace import rank_bucket, web_vitals_p95, web_vitals_p95_exact
from millrace.plans.marts import mart_cohort_retention
from millrace.plans.serving import agg_daily_sales
from millrace.quality.checks import CheckSpec, blocking, evaluate, execute_checks
from millrace.session import shared_dir
from millrace.sources import files, layers
from millrace.sources.extract import SOURCES, Cursor, extract_all, extract_page, next_cursor
from millrace.sources.jdbc import first_readable
from millrace.sources.kafka import starting_offsets
from millrace.sources.batches import BatchLog
from millrace.streaming.ingest import load_messages
from millrace.vector.schema_docs import COLUMNS_SCHEMA, schema_documents
from millrace.vector.search import l2_normalise, top_k

NOW = datetime(2024, 1, 1)


def one(df):
    return [r[0] for r in df.collect()]


def test_instants():
    assert parse_instant("2024-01-02T03:04:05Z") == datetime(2024, 1, 2, 3, 4, 5, tzinfo=timezone.utc)
    assert run_slug(parse_instant("2024-01-02T03:04:05+02:00")) == "20240102_010405"
    assert run_slug(parse_instant("2024-01-02T03:04:05.garbage")) == "20240102_030405"


def test_masks_and_text(spark):
    df = spark.createDataFrame([(" Ann.Lee@Shop.com ",), ("nodomain",), ("",), (None,)], "e string")
    assert one(df.select(mask_email(F.col("e")))) == ["an***@shop.com", "no***", None, None]
    assert one(df.select(mask_name(F.col("e")))) == ["***", "n***", None, None]
    assert one(spark.createDataFrame([("an***@shop.com",), ("x@y",), (None,)], "e string").select(
        email_is_valid(F.col("e")))) == [True, False, None]
    assert one(spark.createDataFrame([("a.b-c d",)], "e string").select(identifier_token(F.col("e")))) == ["a_b_c_d"]


def test_salt_guard(monkeypatch):
    monkeypatch.delenv("MILLRACE_HASH_SALT", raising=False)
    assert resolve_salt(None, production=False) == ""
    with pytest.raises(ValueError):
        resolve_salt(" ", production=True)
    monkeypatch.setenv("MILLRACE_HASH_SALT", "env")
    assert resolve_salt("arg", production=True) == "env"


def test_moments(spark):
    texts = ["2024-01-01T00:00:00Z", "2024-01-01T02:00:00+02:00", "2024-01-01T00:00:00", "1704067200", "1704067200000",
             "garbage", None]
    got = one(spark.createDataFrame([(t,) for t in texts], "t string").select(parse_moment(F.col("t"))))
    assert got == [NOW] * 5 + [None, None]


def message(spark, values, partition=0):
    return spark.createDataFrame([("t", partition, i, NOW, v) for i, v in enumerate(values)],
                                 "topic string, partition int, offset bigint, timestamp timestamp_ntz, value string")


def test_message_rows(spark):
    got = order_rows(message(spark, [
        '{"event_id":"e","order_id":1,"user_id":2,"amount":3.5,"currency":"EURO","country_code":""}', "plain", "[1]",
        None])).orderBy("kafka_offset").collect()
    assert (got[0]["customer_id"], got[0]["total_amount"], got[0]["currency"], got[0]["country_code"]) == (
        2, Decimal("3.50"), "EUR", None)
    assert [r["payload"] for r in got[1:3]] == ['{"_raw":"plain"}', '{"_raw":"[1]"}']
    ext = message(spark, ['{"event_id":"","timestamp":"bad"}', "{}"])
    nowhere = ext.withColumn("offset", F.lit(None).cast("bigint"))
    got = extension_rows(ext.unionByName(nowhere), "web").orderBy("kafka_offset").collect()
    assert len(got) == 2 and got[0]["event_id"] == "" and got[0]["event_ts"] == NOW


def test_contract(spark):
    rule = Contract(required=("a",), non_negative=("n",), positive=("p",), country=("c",), currency=("m",),
                    allowed={"s": ("x", "y")})
    df = spark.createDataFrame([("1", 1, 1, "DE", "EUR", "x"), (None, -1, 0, "de", "EURO", "z"),
                                ("1", None, None, None, None, None)],
                               "a string, n int, p int, c string, m string, s string")
    assert [len(v) for v in one(with_violations(df, rule).select("violations"))] == [0, 6, 0]
    good, bad = split(df, rule)
    assert good.count() == 2 and bad.count() == 1


def test_files(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.jsonl").write_text('{"id": 1}\n\n{"id": \n{"id": 3}\n')
    (folder / "b.csv").write_text("id,name\n1,x\n2,\n")
    listing = files.list_files(spark, str(folder))
    path = {p.rsplit("/", 1)[-1]: p for p in one(listing.select("file_path"))}
    good, bad = files.split_bad_lines(files.read_jsonl(spark, path["a.jsonl"], "id int"))
    assert sorted(one(good.select("id"))) == [1, 3] and bad.count() == 1
    rows = files.reader_for(path["b.csv"])(spark, path["b.csv"])
    assert rows.dtypes[:2] == [("id", "string"), ("name", "string")] and rows.count() == 2
    with pytest.raises(ValueError):
        files.reader_for("x.xml")
    manifest = spark.createDataFrame([(path["a.jsonl"], 1, "quarantined", 0, "bad", None, None),
                                      (path["b.csv"], 1, "discovered", 0, None, None, None)], files.MANIFEST_SCHEMA)
    assert one(files.discover(listing, manifest, 5).select("file_path")) == [path["b.csv"]]
    assert files.discover(listing, manifest, 5, retry_quarantined=True).count() == 2
    assert files.discover(listing, manifest, 1, retry_quarantined=True).count() == 1
    same = [files.with_row_identity(files.read_jsonl(spark, path["a.jsonl"], "id int")).select("line_hash") for _ in "ab"]
    assert same[0].exceptAll(same[1]).count() == 0


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, "r1", date(2024, 1, 1)), (2, "r2", date(2024, 1, 2))], "id int, run_id string, d date")
    for fmt in ("jsonl", "csv", "parquet"):
        files.write_dated(df, str(tmp_path / fmt), "d", fmt)
        assert (tmp_path / fmt / "d=2024-01-02").exists()
    runs = str(tmp_path / "runs")
    files.write_run(df, runs)
    files.write_run(df.filter("id = 2").withColumn("id", F.lit(9)), runs)
    assert sorted(one(spark.read.parquet(runs).select("id"))) == [1, 9]
    layers.full_refresh(df, str(tmp_path / "full"), cluster_by="d")
    layers.append_delta(df, str(tmp_path / "full"))
    assert spark.read.parquet(str(tmp_path / "full")).count() == 4
    assert "mart_load_dts" in layers.stamped(df, NOW).columns


def test_cursors(spark):
    assert Cursor.parse(None) == Cursor() and Cursor.parse("2024-01-01 00:00:00") == Cursor("2024-01-01 00:00:00")
    assert Cursor.parse(Cursor("x", 5).text()) == Cursor("x", 5)
    spec = SOURCES["orders"]
    data = [(i, 1, datetime(2024, 1, 1 + i // 3), "s", "EUR", Decimal(1)) for i in range(10)]
    df = spark.createDataFrame(data, "order_id bigint, user_id bigint, order_ts timestamp_ntz, status string, "
                                     "currency_code string, total_amount decimal(12,2)")
    cursor, seen = Cursor(), []
    for _ in range(5):
        page = extract_page(df, spec, cursor, 4)
        seen += one(page.select("order_id"))
        cursor = next_cursor(page, spec, cursor)
    assert sorted(seen) == list(range(10))
    assert list(extract_all({"orders": df}, {"orders": cursor}, 4)) == []
    drained = list(extract_all({"orders": df}, {}, 4))
    assert [p.count() for _, p, _ in drained] == [4, 4, 2] and drained[-1][2] == cursor
    assert starting_offsets("t", {0: 5}, 2) == '{"t": {"0": 6, "1": -2}}'


def test_a_page_is_written_before_its_cursor_is_taken(spark, monkeypatch):
    """A page that is computed again for its cursor could end elsewhere, and rows between the ends would be lost."""
    read = []

    def spied(page, spec, cursor):
        read.append(page.inputFiles())
        return next_cursor(page, spec, cursor)

    monkeypatch.setattr("millrace.sources.extract.next_cursor", spied)
    spec = SOURCES["orders"]
    data = [(i, 1, datetime(2024, 1, 1 + i), "s", "EUR", Decimal(1)) for i in range(5)]
    df = spark.createDataFrame(data, "order_id bigint, user_id bigint, order_ts timestamp_ntz, status string, currency_code string, total_amount decimal(12,2)")
    pages = [p for _, p, _ in extract_all({spec.table: df}, {}, 2)]
    assert [sorted(one(p.select("order_id"))) for p in pages] == [[0, 1], [2, 3], [4]]
    assert all(files and all("/page-orders/" in f for f in files) for files in read) and len(read) == 4


def test_run_start_is_repeatable(spark):
    empty = spark.createDataFrame([], runs.SCHEMA)
    starting = spark.createDataFrame([(str(i), "d", "t", None, None, None if i else '{"a":1}') for i in range(3)],
                                     "run_id string, dag_id string, task_id string, source string, layer string, payload string")
    once = runs.start(empty, starting, NOW)
    again = runs.start(once, starting.unionByName(starting), datetime(2030, 1, 1))
    assert once.columns == empty.columns and sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, again.collect()), key=str)
    assert {(r["status"], r["finished_at"], r["payload"]) for r in once.collect()} == {("running", None, "{}"), ("running", None, '{"a":1}')}


def test_ingest_resumes_after_stored_offsets(spark, tmp_path):
    target = BatchLog(spark, str(tmp_path / "raw"), order_rows(message(spark, ["{}"])).schema)
    marks = BatchLog(spark, str(tmp_path / "marks"), watermarks.SCHEMA)
    log = message(spark, ["{}"] * 5).unionByName(message(spark, ["{}"] * 2, partition=1))
    runs = [load_messages(log, order_rows, target, marks, "p", NOW, limit=4) for _ in range(3)]
    assert [r.rows_in for r in runs] == [4, 3, 0] and target.read().count() == 7
    assert watermarks.get_offsets(watermarks.newest(marks), "p") == {0: 4, 1: 1}
    # A lost mark repeats messages; those that are stored already do not count.
    again = BatchLog(spark, str(tmp_path / "marks2"), watermarks.SCHEMA)
    again.put(watermarks.watermark_row(spark, "p", '{"0": 1}', NOW, 2), 4)
    late = load_messages(log, order_rows, target, again, "p", NOW)
    assert (late.rows_in, late.rows_out) == (5, 0) and target.read().count() == 7


def test_checks(spark, tmp_path):
    tables = {"t": spark.createDataFrame([(1, 5), (1, -1), (None, 3)], "k int, v int"),
              "p": spark.createDataFrame([(2,)], "k int")}
    specs = [CheckSpec("u", "t", "unique", columns=("k",)), CheckSpec("n", "t", "not_null", "warning", ("k",)),
             CheckSpec("r", "t", "range", columns=("v",), min_value=0, max_value=4),
             CheckSpec("free", "t", "range", columns=("v",)),
             CheckSpec("o", "t", "referential", columns=("k",), parent_table="p", parent_column="k"),
             CheckSpec("i", "t", "referential", columns=("k",), parent_table="p", parent_column="k", null_child="ignore"),
             CheckSpec("m", "t", "min_row_count", min_rows=3)]
    got = {r["check_name"]: r["observed_value"] for r in evaluate(specs, tables).collect()}
    assert got == {"u": "1", "n": "1", "r": "2", "free": "0", "o": "3", "i": "2", "m": "3"}
    broken = CheckSpec("b", "t", "not_null", columns=("missing",))
    results = execute_checks([specs[1], specs[3], broken], tables, NOW)
    found = {r["check_name"]: r for r in results.collect()}
    assert {k: r["passed"] for k, r in found.items()} == {"n": False, "free": True, "b": False}
    assert one(blocking(results).select("check_name")) == ["b"] and found["b"]["error"] and found["n"]["checked_at"] == NOW
    assert found["b"]["observed_value"] is None and recent_results(results, NOW).count() == 3
    with pytest.raises(ValueError):
        execute_checks([CheckSpec("x", "t", "nonsense")], tables, NOW)
    paths = layers.store_failures(specs[:2], tables, str(tmp_path))
    assert spark.read.parquet(paths[1]).count() == 1


def test_payment_state_needs_success(spark):
    link = spark.createDataFrame([("o1", "p1"), ("o1", "p2"), ("o2", "p3")], "order_hub_key string, payment_hub_key string")
    sat = spark.createDataFrame([("p1", "SUCCESS", Decimal(5), True), ("p2", "failed", Decimal(7), True),
                                 ("p3", "captured", Decimal(9), True)], "hub_key string, status string, amount decimal(14,2), is_current boolean")
    got = {r["hub_key"]: (r["paid"], r["paid_total"]) for r in payments_per_order(link, sat).collect()}
    assert got == {"o1": (True, Decimal(5)), "o2": (False, Decimal(0))}
    wider = {r["hub_key"]: r["paid"] for r in payments_per_order(link, sat, ("success", "captured")).collect()}
    assert wider == {"o1": True, "o2": True}


def test_retention_grain_has_three_columns(spark):
    orders = spark.createDataFrame([("a", date(2024, 1, 1)), ("b", date(2024, 1, 3)), ("a", date(2024, 1, 5)),
                                    ("b", date(2024, 1, 5)), ("b", date(2024, 1, 5))], "customer_hub_key string, order_date date") \
        .withColumns({"total_amount": F.lit(1).cast("decimal(14,2)"), "paid_amount": F.lit(1).cast("decimal(14,2)"),
                      "payment_state": F.lit("unpaid")})
    got = sorted((r["activity_date"].day, r["days_since_first_order"], r["active_users"], r["cohort_size"])
                 for r in mart_cohort_retention(orders).collect())
    assert got == [(1, 0, 1, 2), (3, 0, 1, 2), (5, 2, 1, 2), (5, 4, 1, 2)]


def test_moving_average_counts_rows_or_days(spark):
    days = [1, 2, 3, 10]
    df = spark.createDataFrame([("e", date(2024, 1, d), Decimal(d)) for d in days], "currency string, order_date date, gross_sales decimal(24,2)")
    by_row = {r["order_date"].day: r for r in agg_daily_sales(df).collect()}
    by_day = {r["order_date"].day: r for r in agg_daily_sales(df, calendar_days=True).collect()}
    assert by_row[10]["gross_sales_7d_ma"] == 4.0 and by_day[10]["gross_sales_7d_ma"] == 10.0
    assert by_row[10]["gross_sales_lag_7d"] is None and by_day[10]["gross_sales_lag_7d"] == Decimal(3)
    assert by_day[10]["wow_growth"] == pytest.approx(7 / 3)


def test_percentiles(spark):
    rng = np.random.default_rng(1)
    values = np.round(rng.uniform(0, 100, 500), 2)
    df = spark.createDataFrame([(NOW, float(v), float(v), float(v)) for v in values],
                               "metric_ts timestamp_ntz, lcp double, fid double, cls double")
    exact = web_vitals_p95_exact(df).first()
    assert exact["lcp_p95"] == pytest.approx(np.percentile(values, 95), abs=1e-6) and exact["samples"] == 500
    assert abs(web_vitals_p95(df).first()["lcp_p95"] - np.percentile(values, 95)) < 1
    assert one(spark.createDataFrame([(3,), (10,), (51,)], "p int").select(rank_bucket(F.col("p")))) == [
        "top_3", "top_10", "beyond"]


def test_top_k_in_blocks_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(300, 8)).astype(np.float32)
    vectors[10] = vectors[11]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<float>").repartition(5)
    unit = df.select("vec_id", l2_normalise(F.col("embedding")).alias("embedding"))
    queries = unit.filter("vec_id < 40").withColumnRenamed("vec_id", "query_id")
    got = {}
    for r in top_k(unit, queries, 4, block_values=8 * 7).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
    u = np.array([r["embedding"] for r in unit.orderBy("vec_id").collect()])
    for q in range(40):
        order = sorted(range(300), key=lambda i: (-float(u[q] @ u[i]), i))[:4]
        scores = [round(float(u[q] @ u[i]), 9) for i in order]
        assert [round(float(u[q] @ u[got[q][k]]), 9) for k in (1, 2, 3, 4)] == scores
        assert [got[q][k] for k in (1, 2, 3, 4)] == order
    assert top_k(unit, queries.limit(0), 3).count() == 0


def test_top_k_with_repeated_and_missing_ids_and_ragged_vectors(spark):
    corpus = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [1.0]), (5, [])], "vec_id bigint, embedding array<double>")
    queries = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (2, [1.0, 0.0]), (None, [0.0, 1.0]), (None, [0.0, 1.0]), (6, None), (7, [2.0])],
                                    "query_id bigint, embedding array<double>")
    for block_values in (2, 4, 1000):
        got = sorted(((r["query_id"], r["vec_id"]) for r in top_k(corpus, queries, 1, block_values).collect()), key=str)
        assert got == sorted([(1, 1), (2, 2), (2, 1), (None, 2), (None, 2), (7, 4)], key=str)


def test_schema_documents_and_fallback_table(spark):
    rows = spark.createDataFrame([("s", "t", 2, "b", "int"), ("s", "t", 1, "a", "text")], COLUMNS_SCHEMA)
    assert schema_documents(rows).first()["document"] == "s.t: a (text), b (int)"
    spark.range(3).createOrReplaceTempView("second_choice")
    df = first_readable(spark, ("first_choice", {"n": "x"}), ("second_choice", {"n": "id"}))
    assert df.columns == ["n"] and df.count() == 3
    with pytest.raises(RuntimeError):
        first_readable(spark, ("nothing_here", {}))


def test_training_needs_rows_and_saves(spark, tmp_path):
    rows = [(str(i), ["a", "b"][i % 2], "EUR", str(i % 300), NOW, float(1 + i % 7)) for i in range(400)]
    df = spark.createDataFrame(rows, "order_bk string, status string, currency string, customer_bk string, order_ts timestamp_ntz, total_amount double")
    with pytest.raises(ValueError):
        train(df.limit(10), NOW)
    model, metrics = train(df, NOW, TrainingSpec(max_iter=2, max_depth=2))
    row = metrics.first()
    assert np.isfinite(list(row.asDict().values())).all() and 250 < row["train_rows"] < 390
    scored = model.transform(training_frame(df, NOW, TrainingSpec()).filter("NOT in_training")).toPandas()
    error = scored["label"] - scored["prediction"]
    again = train(df.repartition(7), NOW, TrainingSpec(max_iter=2, max_depth=2))[1].first()
    assert again["train_rows"] == row["train_rows"]
    assert row["rmse"] == pytest.approx(np.sqrt((error ** 2).mean())) and row["mae"] == pytest.approx(error.abs().mean())
    assert row["r2"] == pytest.approx(1 - (error ** 2).sum() / ((scored["label"] - scored["label"].mean()) ** 2).sum())
    save(model, str(tmp_path / "model"))


def test_rates_default_to_one(spark):
    daily = spark.createDataFrame([(date(2024, 1, 1), "USD", Decimal(2)), (date(2024, 1, 2), "USD", Decimal(2))],
                                  "order_date date, currency string, gross_sales decimal(24,2)")
    rates = finance.rate_table(spark, [(date(2024, 1, 1), "USD", 90.0)])
    assert sorted(one(finance.with_rate(daily, rates).select("rate_to_rub"))) == [1.0, 90.0]


def test_shared_folder_is_never_local_on_a_cluster(spark):
    class Conf:
        def __init__(self, value):
            self.value = value

        def get(self, key, default):
            return self.value or default

    class Fake:
        def __init__(self, value, master):
            self.conf = Conf(value)
            self.sparkContext = type("C", (), {"master": master, "applicationId": "a"})()

    assert shared_dir(Fake("hdfs://shared", "yarn")) == "hdfs://shared"
    with pytest.raises(RuntimeError):
        shared_dir(Fake(None, "yarn"))
