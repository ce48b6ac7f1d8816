"""Sales converted with a daily rate table, and ledger balance."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RATE_SCHEMA = "rate_date date, currency string, rate_to_rub double"


def rate_table(spark: SparkSession, rates: Iterable[tuple[date, str, float]]) -> DataFrame:
    """Rates fetched elsewhere, one per day and currency."""
    return spark.createDataFrame(list(rates), RATE_SCHEMA)


def in_window(df: DataFrame, start: date, end: date) -> DataFrame:
    return df.filter(F.col("order_date").between(F.lit(start), F.lit(end)))


def rate_dates(daily: DataFrame, orders: DataFrame) -> DataFrame:
    """Every date a rate is needed for."""
    return daily.select("order_date").union(orders.select("order_date")).distinct() \
        .filter(F.col("order_date").isNotNull())


def with_rate(df: DataFrame, rates: DataFrame) -> DataFrame:
    """Adds ``rate_to_rub``; 1.0 where the table has none.

    Rates hold one row per day and currency. The size is left to run-time statistics: a
    decade in five currencies is broadcast, a table that outgrew the limit is shuffled.
    """
    named = rates.select(F.col("rate_date").alias("order_date"), "currency", "rate_to_rub")
    return df.join(named, ["order_date", "currency"], "left").withColumn(
        "rate_to_rub", F.coalesce("rate_to_rub", F.lit(1.0)))


def mart_daily_finance_rub(daily: DataFrame, rates: DataFrame, run_id: str) -> DataFrame:
    gross = F.col("gross_sales").cast("double")
    return with_rate(daily, rates).select(
        F.lit(run_id).alias("run_id"), "order_date", "currency", gross.alias("gross_sales"), "rate_to_rub",
        F.round(gross * F.col("rate_to_rub"), 4).alias("gross_sales_rub"),
        F.col("order_count").cast("long"), F.col("avg_order_value").cast("double"))


def mart_order_mix_rub(orders: DataFrame, rates: DataFrame, run_id: str) -> DataFrame:
    """Orders per day, currency and payment state in both currencies.

    The rate is constant per day and currency, so amounts are summed first (exactly, as
    DECIMAL) and converted once per group; the join meets the grouped rows only.
    """
    mix = orders.groupBy("order_date", "currency", "payment_state").agg(
        F.count(F.lit(1)).alias("order_count"), F.sum("total_amount").cast("double").alias("revenue_orig"))
    return with_rate(mix, rates).select(
        F.lit(run_id).alias("run_id"), "order_date", "currency", "payment_state", "order_count", "revenue_orig",
        F.round(F.col("revenue_orig") * F.col("rate_to_rub"), 4).alias("revenue_rub"))


def unbalanced_entries(ledger: DataFrame) -> DataFrame:
    """Journal entries whose debit and credit legs do not cancel."""
    entry = F.regexp_replace("gl_entry_bk", "(?i)-[dc]$", "")
    legs = ledger.groupBy(entry.alias("entry_bk")).agg(
        F.sum("debit_amount").cast("decimal(24,2)").alias("debit"),
        F.sum("credit_amount").cast("decimal(24,2)").alias("credit"))
    return legs.withColumn("difference", (F.col("debit") - F.col("credit")).cast("decimal(24,2)")) \
        .filter(F.col("difference") != 0)
