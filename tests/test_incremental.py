"""Facts, marts, customer views and point-in-time tables kept by changes, against full builds."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest

from millrace.operators.pit import build_pit
from millrace.operators.scd2 import SatSpec, build_satellite
from millrace.plans import marts, serving
from millrace.plans.incremental import DailyMarts
from millrace.plans.loads import PitTable, SatelliteTable
from millrace.sources.partitions import PartitionedTable, values_of

ORDERS = ("order_hub_key string, order_bk string, customer_hub_key string, status string, currency string, total_amount decimal(14,2), is_high_value boolean, "
          "total_items long, total_quantity long, has_successful_payment boolean, paid_amount decimal(24,2), payment_state string, order_ts timestamp, "
          "order_date date, bdv_load_dts timestamp")
PAYMENTS = "payment_hub_key string, order_hub_key string, amount decimal(14,2), status string"
START = datetime(2024, 1, 1, 12)


def order(n, day, customer="c1", amount="10.00", currency="USD", state="fully_paid"):
    ts = None if day is None else START + timedelta(days=day, minutes=n)
    return (f"o{n}", str(n), customer, "paid", currency, Decimal(amount) if amount else None, bool(n % 2), 1, 2, True, None, state, ts, ts and ts.date(), START)


def check(kept, spark, rows, orders, payments):
    """Every kept table equals its full build over the present orders and payments."""
    facts, paid = spark.createDataFrame(orders, ORDERS), spark.createDataFrame(payments, PAYMENTS)
    sales = marts.fct_daily_sales(facts)
    customers = spark.createDataFrame([(c, *[None] * 10) for c in ("c1", "c2", "c3", "c9")], ", ".join(
        f"{n} string" for n in ("customer_hub_key", "customer_bk", "customer_hash", "masked_email", "masked_name", "registered_at", "email_domain",
                                "is_email_valid", "customer_segment", "spend_90d", "order_count_90d")))
    assert rows(kept.fct_orders()) == rows(facts)
    assert rows(kept.fct_daily_sales()) == rows(sales)
    assert rows(kept.agg_daily_sales()) == rows(serving.agg_daily_sales(sales))
    assert rows(kept.mart_daily_business_kpis()) == rows(marts.mart_daily_business_kpis(facts))
    assert rows(kept.mart_cohort_retention()) == rows(marts.mart_cohort_retention(facts))
    assert rows(kept.mv_customer_360(customers)) == rows(serving.mv_customer_360(customers, facts, paid))


def test_loads_equal_full_builds(spark, rows, tmp_path):
    """Late orders, a first order that moves away, a changed customer, lost extremes, an emptied day, nulls, payments before orders."""
    kept = DailyMarts(spark, str(tmp_path), spark.createDataFrame([], ORDERS).schema, buckets=2, grain="week")
    paid = [("p1", "o1", Decimal("4.00"), "success"), ("p2", "o2", Decimal("5.00"), "failed"), ("p7", "o70", Decimal("7.00"), "success")]
    kept.load_payments(spark.createDataFrame(paid, PAYMENTS))
    first = [order(1, 0), order(2, 9), order(3, 9, "c2"), order(4, 20, None), order(5, None, "c2"), order(6, 21, "c3", currency="EUR"), *[order(10 + d, 2 * d, "c2") for d in range(12)]]
    kept.load(spark.createDataFrame(first, ORDERS))
    changes = {1: order(1, 15, "c1", "99.00"), 2: order(2, 9, "c3", state="unpaid"), 6: order(6, 1, "c3", None, "EUR"), 21: order(21, 40, "c2"), 70: order(70, 3, "c1")}
    present = [changes.pop(int(o[1]), o) for o in first]
    kept.load(spark.createDataFrame([*[p for p, o in zip(present, first) if p != o], *changes.values()], ORDERS))
    present += changes.values()
    check(kept, spark, rows, present, paid)
    paid[1] = ("p2", "o2", Decimal("6.50"), "success")
    kept.load_payments(spark.createDataFrame([paid[1]], PAYMENTS))
    kept.load(spark.createDataFrame(present[:3], ORDERS))
    kept.rebuild()
    check(kept, spark, rows, present, paid)


def test_partitions_that_a_load_does_not_touch_stay(spark, tmp_path):
    kept = DailyMarts(spark, str(tmp_path), spark.createDataFrame([], ORDERS).schema, buckets=2)
    kept.load(spark.createDataFrame([order(1, 0), order(2, 50), order(3, 100, "c2")], ORDERS))
    files = lambda name: {p: p.stat().st_mtime_ns for p in (tmp_path / name).glob("period=*/*.parquet")}
    before = {n: files(n) for n in ("fct_orders", "fct_daily_sales", "mart_daily_business_kpis")}
    assert [str(d) for d in kept.load(spark.createDataFrame([order(4, 100, "c2")], ORDERS))] == ["2024-04-10"]
    for name, old in before.items():
        kept_files = {p for p, t in files(name).items() if old.get(p) == t}
        assert {p.parent.name for p in kept_files} == {"period=2024-01-01", "period=2024-02-20"}, name
    plan = kept.orders.read([START.date()])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(period" in plan or "PartitionFilters: [(period" in plan


@pytest.mark.parametrize("values", [[1, 2], [1]])
def test_replaced_partitions(spark, rows, tmp_path, values):
    table = PartitionedTable(spark, str(tmp_path / "t"), "k", spark.createDataFrame([], "v string, k int").schema)
    assert table.read().count() == 0
    table.append(spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "v string, k int"))
    table.replace(values, table.read(values).filter("k = 1").selectExpr("concat(v, v) AS v", "k"))
    assert rows(table.read()) == sorted([("aa", 1), ("c", 3), *([("b", 2)] if values == [1] else [])])
    assert values_of(table.read(), "k") == sorted({1, 3, *({2} if values == [1] else ())})


def test_satellite_and_pit_by_change(spark, rows, tmp_path):
    spec = SatSpec("s", "src", ("value",))
    schema = "hub_key string, hashdiff string, load_dts timestamp, effective_from timestamp, record_source string, value int"
    seen = lambda k, h, day: (k, h, START, START + timedelta(days=day), "src", 1)
    loads = [[seen("a", "x", 0), seen("b", "x", 2), seen("a", "x", 8)], [seen("a", "y", 5), seen("c", "x", 1)], []]
    table = SatelliteTable(spark, str(tmp_path / "s"), spec, buckets=8)
    pit = PitTable(spark, str(tmp_path / "p"), [("s", table)], 10)
    hub = spark.createDataFrame([("a",), ("b",), ("d",)], "hub_key string")
    files = lambda: {p: p.stat().st_mtime_ns for p in (tmp_path / "s" / "timeline").glob("bucket=*/*.parquet")}
    every, before = [], {}
    for n, new in enumerate(loads):
        every += new
        before = files()
        changed = table.load(spark.createDataFrame(new, schema))
        whole = build_satellite(spark.createDataFrame(every, schema), spec)
        assert rows(SatelliteTable(spark, str(tmp_path / "s"), spec, buckets=8).rows()) == rows(whole)
        as_of = (START + timedelta(days=9 + n)).date()
        hub = hub.union(spark.createDataFrame([("c",)], "hub_key string")) if n == 1 else hub
        pit.refresh(changed, hub, as_of)
        assert rows(pit.rows()) == rows(build_pit(hub, [("s", whole)], as_of, 10))
        if n == 1:
            assert any(files().get(p) == t for p, t in before.items())
