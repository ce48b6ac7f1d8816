"""Times the headline queries and prints one JSON line.

``warehouse_build`` is the time to build and write every table of the warehouse from the
raw feeds; the other entries are single queries over those tables, each fully computed.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from catalog import QUERIES, warehouse  # noqa: E402
from millrace.session import build_session  # noqa: E402

HEADLINE = (
    "stg_orders", "stg_order_items", "stg_payments", "hub_orders", "link_order_product", "sat_order_history",
    "sat_after_late_load", "bridge_order_product", "sat_order_enriched", "pit_customer", "fct_orders", "fct_daily_sales",
    "mart_daily_business_kpis", "mart_cohort_retention", "mart_user_rfm", "mart_category_performance",
    "agg_daily_sales", "agg_payment_performance", "agg_segment_revenue", "mv_customer_360", "mart_order_mix_rub",
    "dq_results", "parsed_orders", "contract_orders", "changes_applied", "stream_changes_applied", "upsert_orders",
    "keyword_rank_changes", "web_vitals_p95", "worked_time", "order_item_totals", "vector_top_k", "order_value_model")


def compute(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    compute(spark.range(1000))
    wh = warehouse(spark, directory)
    times: dict[str, float] = {}

    start = time.perf_counter()
    wh.build()
    times["warehouse_build"] = round(time.perf_counter() - start, 3)
    for name in HEADLINE:
        start = time.perf_counter()
        compute(QUERIES[name](spark, directory))
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": Path(directory).name.removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
