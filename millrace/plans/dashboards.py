"""Dashboard and chart queries over marts and pre-aggregations."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.measures import ratio


def last_days(df: DataFrame, column: str, as_of: date, days: int) -> DataFrame:
    return df.filter(F.col(column) >= F.lit(as_of - timedelta(days=days)))


def number(df: DataFrame, value: Column) -> DataFrame:
    """Single value, 0 when there is nothing to aggregate."""
    return df.agg(F.coalesce(value.cast("double"), F.lit(0.0)).alias("value"))


def gmv_today(kpis: DataFrame, as_of: date) -> DataFrame:
    return number(kpis.filter(F.col("metric_date") == F.lit(as_of)), F.sum("gmv"))


def net_revenue_30d(kpis: DataFrame, as_of: date) -> DataFrame:
    return number(last_days(kpis, "metric_date", as_of, 30), F.sum("net_revenue"))


def aov_30d(kpis: DataFrame, as_of: date) -> DataFrame:
    return number(last_days(kpis, "metric_date", as_of, 30), ratio(F.sum("gmv"), F.sum("orders_count")))


def d30_retention(cohorts: DataFrame, as_of: date) -> DataFrame:
    marked = last_days(cohorts.filter(F.col("canonical_day_marker") == 30), "activity_date", as_of, 90)
    return number(marked, F.round(F.avg("retention_rate"), 6))


def sums_over_time(df: DataFrame, day: str, values: dict[str, str], as_of: date | None = None, days: int = 0,
                   by: tuple[str, ...] = ()) -> DataFrame:
    """Time series: one row per day (and group), ``values`` maps output names to summed columns."""
    rows = df if as_of is None else last_days(df, day, as_of, days)
    return rows.groupBy(F.col(day).alias("time"), *by).agg(
        *[F.sum(c).cast("double").alias(n) for n, c in values.items()])


def top_groups(df: DataFrame, by: str, value: Column, rows: int, name: str = "value") -> DataFrame:
    """Largest groups first, ties by group."""
    return df.groupBy(by).agg(value.alias(name)).orderBy(
        F.col(name).desc_nulls_last(), F.col(by).asc_nulls_last()).limit(rows)


def top_categories_30d(categories: DataFrame, as_of: date) -> DataFrame:
    return top_groups(last_days(categories, "metric_date", as_of, 30), "category",
                      F.sum("gross_revenue").cast("double"), 10)


def unit_economics_table(economics: DataFrame, rows: int = 24) -> DataFrame:
    return economics.select(
        "cohort_month", "customers_count", "avg_ltv_30d", "avg_ltv_90d", "avg_ltv_180d", "avg_ltv_365d", "avg_cac",
        "ltv_cac_ratio", "payback_months", "limitations_note").orderBy(F.col("cohort_month").desc()).limit(rows)


def top_products(bridge: DataFrame, products: DataFrame, rows: int = 20) -> DataFrame:
    """Products by line revenue; summed per product before the names are joined."""
    sums = bridge.groupBy("product_hub_key").agg(F.sum("total_line_amount").cast("decimal(24,2)").alias("revenue"))
    named = sums.join(products.select("product_hub_key", "product_bk", "product_name"), "product_hub_key")
    return named.orderBy(F.col("revenue").desc(), F.col("product_bk").asc()).limit(rows)


def items_per_order(orders: DataFrame) -> DataFrame:
    return orders.agg(ratio(F.sum("total_quantity"), F.count("total_quantity")).alias("avg_items_per_order"))


def rolling_retention(rfm: DataFrame) -> DataFrame:
    """Share of a cohort that bought again at least n days after the first order."""
    age = F.datediff("last_order_date", "first_order_date")
    return rfm.groupBy(F.trunc("first_order_date", "month").alias("cohort_month")).agg(
        F.count(F.lit(1)).alias("cohort_size"),
        *[ratio(F.count_if(age >= n), F.count(F.lit(1))).alias(f"rolling_{n}d") for n in (1, 7, 30, 90)])


def purchase_frequency(rfm: DataFrame) -> DataFrame:
    return rfm.agg(ratio(F.sum("orders_total"), F.count(F.lit(1))).alias("orders_per_customer"),
                   ratio(F.count_if(F.col("orders_total") > 1), F.count(F.lit(1))).alias("repeat_share"))
