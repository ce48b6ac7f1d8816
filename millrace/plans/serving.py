"""Pre-aggregations for dashboards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.measures import flag_count, mean_of, ratio, sum_where

MONEY = "decimal(24,2)"


def agg_daily_sales(daily: DataFrame, calendar_days: bool = False) -> DataFrame:
    """Moving averages and week-over-week growth per currency.

    Frames count rows, so a missing day widens them; ``calendar_days=True`` uses ranges
    of days instead. Input is one row per day and currency, which bounds every window.
    """
    if calendar_days:
        by_day = W.partitionBy("currency").orderBy(F.datediff("order_date", F.lit("1970-01-01").cast("date")))
        week, month, week_ago = by_day.rangeBetween(-6, 0), by_day.rangeBetween(-29, 0), by_day.rangeBetween(-7, -7)
        before = F.max("gross_sales").over(week_ago)
    else:
        by_row = W.partitionBy("currency").orderBy("order_date")
        week, month = by_row.rowsBetween(-6, 0), by_row.rowsBetween(-29, 0)
        before = F.lag("gross_sales", 7).over(by_row)

    def average(frame) -> F.Column:
        return mean_of(F.sum("gross_sales").over(frame), F.count("gross_sales").over(frame))

    moved = daily.withColumns({
        "gross_sales_7d_ma": average(week), "gross_sales_30d_ma": average(month), "gross_sales_lag_7d": before})
    growth = ratio(F.col("gross_sales") - F.col("gross_sales_lag_7d"), F.col("gross_sales_lag_7d"))
    return moved.withColumn("wow_growth", growth)


def agg_payment_performance(payments: DataFrame) -> DataFrame:
    status, amount = F.col("status"), F.col("amount")
    usable = payments.dropna(subset=["payment_date", "payment_method"])
    grouped = usable.groupBy("payment_date", "payment_method", "currency").agg(
        F.count(F.lit(1)).alias("attempts"), flag_count(status == "success").alias("successes"),
        flag_count(status.isin("failed", "declined")).alias("failures"),
        sum_where(status == "success", amount).cast(MONEY).alias("paid_amount"),
        sum_where(status != "success", amount).cast(MONEY).alias("rejected_amount"))
    return grouped.withColumn("success_rate", ratio(F.col("successes"), F.col("attempts")))


def agg_segment_revenue(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Revenue per day and segment.

    Orders are summed per customer and day before they meet the dimension, so the join
    moves no more than one row per customer and day.
    """
    per_customer = orders.dropna(subset=["order_date", "customer_hub_key"]).groupBy(
        "customer_hub_key", "order_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("total_amount").alias("gross"),
        sum_where(F.col("payment_state") == "fully_paid", F.col("total_amount")).alias("paid"),
        flag_count(F.col("is_high_value")).alias("high"))
    segments = customers.select("customer_hub_key", "customer_segment").dropna(subset=["customer_segment"])
    return per_customer.join(segments, "customer_hub_key").groupBy("order_date", "customer_segment").agg(
        F.sum("n").alias("order_count"), F.sum("gross").cast(MONEY).alias("gross_sales"),
        F.sum("paid").cast(MONEY).alias("paid_sales"), F.sum("high").alias("high_value_orders"))


def mv_customer_360(customers: DataFrame, orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Customer attributes with lifetime orders and payments.

    Payments are summed per order first: that join key is as unique as an order, and the
    customer key only appears after the rows have shrunk.
    """
    known = orders.filter(F.col("customer_hub_key").isNotNull())
    bought = known.groupBy("customer_hub_key").agg(
        F.count(F.lit(1)).alias("lifetime_orders"), F.sum("total_amount").alias("lifetime_gross"),
        sum_where(F.col("payment_state") == "fully_paid", F.col("total_amount")).alias("lifetime_paid"),
        F.count("total_amount").alias("_priced"), F.max("order_ts").alias("last_order_ts"),
        F.min("order_ts").alias("first_order_ts"), flag_count(F.col("is_high_value")).alias("high_value_orders"))
    status = F.col("status")
    per_order = payments.filter(F.col("order_hub_key").isNotNull()).groupBy("order_hub_key").agg(
        sum_where(status == "success", F.col("amount")).alias("paid"),
        flag_count(status == "success").alias("good"), flag_count(status == "failed").alias("bad"))
    paid = known.select("order_hub_key", "customer_hub_key").join(per_order, "order_hub_key").groupBy(
        "customer_hub_key").agg(
        F.sum("paid").alias("lifetime_payments"), F.sum("good").alias("successful_payments"),
        F.sum("bad").alias("failed_payments"))
    return customer_view(customers, bought, paid)


def customer_view(customers: DataFrame, bought: DataFrame, paid: DataFrame) -> DataFrame:
    """Customer attributes beside the sums of their orders and payments."""
    rows = customers.join(bought, "customer_hub_key", "left").join(paid, "customer_hub_key", "left")

    def money(name: str):
        return F.coalesce(name, F.lit(0)).cast(MONEY).alias(name)

    def number(name: str):
        return F.coalesce(name, F.lit(0)).cast("long").alias(name)

    attributes = ("customer_hub_key", "customer_bk", "customer_hash", "masked_email", "masked_name", "registered_at",
                  "email_domain", "is_email_valid", "customer_segment", "spend_90d", "order_count_90d")
    return rows.select(
        *attributes, number("lifetime_orders"), money("lifetime_gross"), money("lifetime_paid"),
        mean_of(F.col("lifetime_gross"), F.col("_priced")).alias("lifetime_aov"), "last_order_ts", "first_order_ts",
        number("high_value_orders"), money("lifetime_payments"), number("successful_payments"),
        number("failed_payments"))
