import re
import shutil
import time

from pyspark.sql import functions as F

from millrace.functions.hashing import digest, hash_parts, key_text
from millrace.plans.warehouse import Clock, Warehouse

from catalog import CLOCK

FOLDER = "/root/testdata/sf0.001"
CHAIN = ("stg_orders", "stg_order_items", "hub_orders", "link_order_product", "bridge_order_product", "bridge_customer_order", "sat_order_status",
         "sat_order_enriched", "fct_orders")


def test_a_digest_of_key_texts_is_the_hash_key(spark):
    rows = spark.createDataFrame([(" a", "B"), ("A ", "b"), (None, " "), ("", None), ("a||b", "c"), ("a", "b||c")], "x string, y string")
    got = rows.select(key_text([F.col("x"), F.col("y")]).alias("t"), hash_parts([F.col("x"), F.col("y")]).alias("h")).withColumn("d", digest(F.col("t")))
    found = got.collect()
    assert all(r["d"] == r["h"] for r in found)
    assert [r["t"] for r in found[:4]] == ["A||B", "A||B", "^^||^^", "^^||^^"]
    assert spark.range(1).select(digest(F.lit(None).cast("string")).alias("d")).first()["d"] is None


def test_written_tables_hold_no_digests(spark, tmp_path):
    folder = str(tmp_path / "in")
    shutil.copytree(FOLDER, folder)
    w = Warehouse(spark, folder, Clock(now=CLOCK.now))
    for name in CHAIN:
        w.table(name)
    for name in CHAIN:
        for row in spark.read.parquet(w._written[name]).limit(20).collect():
            assert not [v for v in row if isinstance(v, str) and re.fullmatch("[0-9a-f]{64}", v)], name
        public = w.table(name)
        hashes = [c for c in public.columns if c.endswith(("hub_key", "link_key", "bridge_key", "hashdiff"))]
        for row in public.select(*hashes).limit(20).collect() if hashes else []:
            assert all(v is None or re.fullmatch("[0-9a-f]{64}", v) for v in row), name
        assert w.frame(name).columns == public.columns and w.frame(name).exceptAll(public).isEmpty()


def test_a_partition_is_written_by_several_tasks(spark, tmp_path, monkeypatch):
    from millrace.sources.partitions import PartitionedTable
    rows = spark.range(60_000).select(F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit(1).alias("k"))
    table = PartitionedTable(spark, str(tmp_path / "t"), "k", rows.schema)
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "512k")
    try:
        table.replace([1, 2], rows)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert len(list((tmp_path / "t" / "k=1").glob("part-*"))) > 1
    assert table.read().count() == 60_000 and table.read().select("v").distinct().count() == 60_000


def test_training_rows_are_spread(spark, monkeypatch):
    from millrace.ml import order_value
    monkeypatch.setattr(order_value, "TASK_ROWS", 10)
    rows = spark.range(95).coalesce(1)
    assert order_value.spread(rows, 95).rdd.getNumPartitions() == 10
    assert order_value.spread(spark.range(9).coalesce(1), 9).rdd.getNumPartitions() == 1


def test_a_task_reads_a_bounded_split(spark):
    from millrace.session import SPLIT_BYTES, apply_defaults
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        for given, want in (("128m", str(SPLIT_BYTES)), ("1m", "1m")):
            spark.conf.set(key, given)
            apply_defaults(spark)
            assert spark.conf.get(key) == want
    finally:
        spark.conf.set(key, before)


def test_a_filter_on_a_wide_change_hash_is_planned_at_once(spark):
    """Sixteen columns; with names for their trimmed texts the planner tried 2^16 forms of the filter."""
    from millrace.functions.hashing import hash_columns, packed
    from millrace.operators.scd2 import SatSpec, first_versions
    names = [f"c{i}" for i in range(16)]
    given = spark.createDataFrame([("k", " ", *["x"] * 15)], ", ".join(f"{c} string" for c in ("bk", *names)))
    staged = given.select("*", key_text([F.col("bk")]).alias("hub_key"), hash_columns(given, names).alias("hashdiff"),
                          *[F.lit(CLOCK.now).alias(c) for c in ("load_dts", "effective_from")], F.lit("s").alias("record_source"))
    versions = first_versions(packed(staged), SatSpec("s", "src", tuple(names)))
    start = time.monotonic()
    assert versions._jdf.queryExecution().optimizedPlan() is not None
    assert time.monotonic() - start < 20
    assert versions.first()["hub_key"] == "K"


def test_equal_training_rows_are_one_weighted_row(spark, monkeypatch):
    from pyspark.testing import assertDataFrameEqual
    from millrace.ml import order_value as m
    rows = spark.range(600).select(
        F.expr("element_at(array('new', 'paid', null), CAST(id % 3 AS INT) + 1)").alias("status"), F.lit("EUR").alias("currency"),
        F.concat(F.lit("c"), (F.col("id") % 7).cast("string")).alias("customer_bk"), (F.col("id") % 4).cast("int").alias("order_hour"),
        F.lit(2).alias("order_dayofweek"), (F.pmod(F.xxhash64("id"), F.lit(1000)) + 100 * (F.col("id") % 7)).cast("double").alias("label")).coalesce(2)
    spec, seen, real = m.TrainingSpec(max_iter=3, max_depth=3, customer_buckets=16), [], m.spread
    monkeypatch.setattr(m, "spread", lambda df, n: seen.append(n) or real(df, n))
    whole = m.fitted(spec, rows, 600)
    monkeypatch.setattr(m, "TASK_ROWS", 100)
    put_together = m.fitted(spec, rows, 600)
    assert seen == [600, 84]
    assert [type(s) for s in put_together.stages] == [type(s) for s in whole.stages]
    predictions = [model.transform(rows).select("customer_bk", "status", "order_hour", F.round("prediction", 6).alias("p")).distinct() for model in (whole, put_together)]
    assertDataFrameEqual(*predictions, rtol=1e-6)
