"""Daily facts, marts and customer views kept by changes.

A load brings the present rows of new and corrected orders (and payments). The periods they leave and those they arrive at are
affected; facts and marts are partitioned by period (days, or longer ones where a day has few rows), and only the affected partitions
are read and overwritten. What crosses periods is kept in states by bucket of customers or orders: how many orders a customer has on each day, what a customer bought
and paid. States change by signed rows: the old row of a corrected order counts minus one, the new one plus one. A sum absorbs them;
a least or greatest value is recounted, for those customers only, where the row that held it is gone.

All loads must come one after the other. A load that broke off is repeated after ``rebuild`` has made every derived table anew
from the facts, whose own replacement is repeatable.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.measures import flag_count, sum_where
from ..session import written
from ..sources.partitions import PartitionedTable, bucket_of, values_of
from . import marts, serving

#: Partition of rows without a date.
NO_DATE = date(1000, 1, 1)
#: Rows that the longest moving average looks back, itself included.
LOOK_BACK = 30

_PLACE = "order_hub_key string, customer_hub_key string, period date, bucket int"
_CUSTOMER_DAY = "customer_hub_key string, order_date date, n bigint, bucket int"
_COHORT = "cohort_month date, activity_date date, days_since_first_order bigint, active_users bigint"
_BOUGHT = ("customer_hub_key string, lifetime_orders bigint, lifetime_gross decimal(34,2), lifetime_paid decimal(34,2), _priced bigint, "
           "last_order_ts timestamp, first_order_ts timestamp, high_value_orders bigint, bucket int")
_PAYMENT = "payment_hub_key string, order_hub_key string, amount decimal(14,2), status string, bucket int"
_PAID = "customer_hub_key string, lifetime_payments decimal(34,2), successful_payments bigint, failed_payments bigint, orders bigint, bucket int"


def _struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def signed(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old rows with sign -1 and new ones with sign 1."""
    return old.withColumn("sign", F.lit(-1)).unionByName(new.withColumn("sign", F.lit(1)), allowMissingColumns=True)


class DailyMarts:
    """``fct_orders`` by period and what follows from it."""

    def __init__(self, spark: SparkSession, root: str, orders: T.StructType, buckets: int = 16, grain: str = "day"):
        """``grain``: day, week, month, quarter or year; a partition should hold some hundred megabytes."""
        if grain not in ("day", "week", "month", "quarter", "year"):
            raise ValueError(f"unknown grain {grain}")
        self.spark, self.buckets, self.grain = spark, buckets, grain
        none = spark.createDataFrame([], orders)

        def table(name: str, by: str, schema: T.StructType) -> PartitionedTable:
            return PartitionedTable(spark, f"{root}/{name}", by, schema)

        self.orders = table("fct_orders", "period", self._dated(none, "order_date").schema)
        sales = marts.fct_daily_sales(none)
        self.sales = table("fct_daily_sales", "period", self._dated(sales, "order_date").schema)
        self.moving = table("agg_daily_sales", "period", self._dated(serving.agg_daily_sales(sales), "order_date").schema)
        self.kpis = table("mart_daily_business_kpis", "period", self._dated(marts.mart_daily_business_kpis(none), "metric_date").schema)
        self.cohorts = table("cohort_states", "cohort_month", _struct(_COHORT))
        self.places = table("order_places", "bucket", _struct(_PLACE))
        self.customer_days = table("customer_days", "bucket", _struct(_CUSTOMER_DAY))
        self.bought = table("customer_orders", "bucket", _struct(_BOUGHT))
        self.payments = table("order_payments", "bucket", _struct(_PAYMENT))
        self.paid = table("customer_payments", "bucket", _struct(_PAID))

    def _dated(self, rows: DataFrame, column: str) -> DataFrame:
        return rows.withColumn("period", F.coalesce(F.date_trunc(self.grain, column).cast("date"), F.lit(NO_DATE)))

    # --- loads -----------------------------------------------------------------------------

    def load(self, changed: DataFrame) -> list[date]:
        """Takes the present rows of new and corrected orders, one per order; returns the affected periods."""
        new = written(self._dated(changed, "order_date").withColumn("bucket", bucket_of("order_hub_key", self.buckets)), "changed-orders")
        buckets, keys = values_of(new, "bucket"), new.select("order_hub_key")
        places = self.places.read(buckets)
        periods = sorted({*values_of(places.join(keys, "order_hub_key", "left_semi"), "period"), *values_of(new, "period")})
        there = self.orders.read(periods)
        old = written(there.join(keys, "order_hub_key", "left_semi"), "old-orders")
        orders = written(there.join(keys, "order_hub_key", "left_anti").unionByName(new.drop("bucket")), "periods-of-orders")

        moved = self._move_customers(old, new)
        self._move_payments(keys, places, new)
        # A day that was some customer's first, or is now, counts its new buyers anew.
        firsts = moved.filter(~F.col("before").eqNullSafe(F.col("after"))).select(F.explode(F.array("before", "after")).alias("first_date")).dropna()
        dated = [p for p in periods if p != NO_DATE]
        self.orders.replace(periods, orders)
        self.places.replace(buckets, places.join(keys, "order_hub_key", "left_anti").unionByName(new.select(*self.places.schema.names)))
        self.bought.replace(*self._bought_after(old, new))
        self.sales.replace(dated, self._dated(marts.fct_daily_sales(orders), "order_date"))
        self._refresh_moving(dated)
        self._refresh_kpis(sorted({*dated, *values_of(self._dated(firsts, "first_date"), "period")}))
        return periods

    def _move_customers(self, old: DataFrame, new: DataFrame) -> DataFrame:
        """Updates the customers' days and the cohorts; (customer_hub_key, before, after): first days of touched customers."""
        known = signed(old, new).filter("customer_hub_key IS NOT NULL AND order_date IS NOT NULL")
        change = written(known.groupBy("customer_hub_key", "order_date").agg(F.sum("sign").alias("n"))
                         .withColumn("bucket", bucket_of("customer_hub_key", self.buckets)), "customer-changes")
        buckets, touched = values_of(change, "bucket"), change.select("customer_hub_key").distinct()
        was = self.customer_days.read(buckets)
        now = written(was.unionByName(change).groupBy("customer_hub_key", "order_date", "bucket").agg(F.sum("n").alias("n")).filter("n > 0"), "customer-days")

        def first(days: DataFrame) -> DataFrame:
            mine = days.join(touched, "customer_hub_key", "left_semi")
            return mine.withColumn("first_date", F.min("order_date").over(W.partitionBy("customer_hub_key")))

        def cohort(days: DataFrame) -> DataFrame:
            return days.select(F.trunc("first_date", "month").alias("cohort_month"), F.col("order_date").alias("activity_date"),
                               F.datediff("order_date", "first_date").cast("long").alias("days_since_first_order"))

        before, after = written(first(was), "firsts-before"), written(first(now), "firsts-after")
        cells = ["cohort_month", "activity_date", "days_since_first_order"]
        moved = written(signed(cohort(before), cohort(after)).groupBy(*cells).agg(F.sum("sign").alias("active_users")).filter("active_users <> 0"), "cohort-changes")
        months = values_of(moved, "cohort_month")
        self.cohorts.replace(months, self.cohorts.read(months).unionByName(moved).groupBy(*cells).agg(F.sum("active_users").alias("active_users")).filter("active_users > 0"))
        self.customer_days.replace(buckets, now)
        ends = lambda rows, name: rows.groupBy("customer_hub_key").agg(F.min("first_date").alias(name))
        return written(touched.join(ends(before, "before"), "customer_hub_key", "left").join(ends(after, "after"), "customer_hub_key", "left"), "first-days")

    def _refresh_moving(self, periods: list[date]) -> None:
        """Moving averages of the changed periods and of those that the ``LOOK_BACK`` rows after one reach, by currency."""
        if not periods:
            return
        sales, first = self.sales.read(), min(periods)
        # One row per day and currency. Rows are counted, not days, so a day that went away moves the rows after it, too: all rows are
        # affected that have fewer than LOOK_BACK unchanged rows between them and the last changed period.
        rows = sales.filter(F.col("period") >= first).select("currency", "order_date", "period", F.col("period").isin(periods).cast("int").alias("changed"))
        marks = rows.select("currency").distinct().withColumn("period", F.explode(F.array(*[F.lit(p) for p in periods]))).select(
            "currency", F.col("period").alias("order_date"), "period", F.lit(2).alias("changed"))
        upto = W.partitionBy("currency").orderBy("period", F.desc("changed"), "order_date").rowsBetween(W.unboundedPreceding, 0)
        placed = rows.unionByName(marks).withColumn("at", F.sum((F.col("changed") == 0).cast("int")).over(upto))
        since = F.max(F.when(F.col("changed") > 0, F.col("at"))).over(upto)
        affected = sorted({*periods, *values_of(placed.withColumn("since", since).filter((F.col("changed") == 0) & (F.col("at") - F.col("since") <= LOOK_BACK)), "period")})
        back = F.row_number().over(W.partitionBy("currency").orderBy(F.desc("order_date")))
        low = (sales.filter(F.col("period") < first).select("currency", "order_date", "period").withColumn("back", back)
               .filter(F.col("back") <= LOOK_BACK).agg(F.min("period")).first()[0]) or first
        window = sales.filter(F.col("period").between(low, max(affected))).drop("period")
        self.moving.replace(affected, self._dated(serving.agg_daily_sales(window), "order_date").filter(F.col("period").isin(affected)))

    def _refresh_kpis(self, periods: list[date]) -> None:
        orders = self.orders.read(periods).drop("period")
        buyers = orders.select("customer_hub_key").dropna().distinct()
        buckets = values_of(buyers.select(bucket_of("customer_hub_key", self.buckets)), "bucket")
        firsts = (self.customer_days.read(buckets).join(buyers, "customer_hub_key", "left_semi")
                  .groupBy("customer_hub_key").agg(F.min("order_date").alias("first_date")))
        self.kpis.replace(periods, self._dated(marts.mart_daily_business_kpis(orders, firsts), "metric_date"))

    # --- customer view -----------------------------------------------------------------------

    def _bought_after(self, old: DataFrame, new: DataFrame) -> tuple[list[int], DataFrame]:
        """Touched buckets of the customers' order states and their new rows."""
        known = signed(old, new).filter("customer_hub_key IS NOT NULL")
        plus = lambda c, ok=None: F.sum(F.when(F.lit(True) if ok is None else ok, F.col("sign") * c))
        amount, added, gone = F.col("total_amount"), F.col("sign") > 0, F.col("sign") < 0
        when = lambda side, extreme: extreme(F.when(side, F.col("order_ts")))
        change = written(known.groupBy("customer_hub_key").agg(
            F.sum("sign").alias("lifetime_orders"), plus(amount).alias("lifetime_gross"),
            plus(amount, F.col("payment_state") == "fully_paid").alias("lifetime_paid"), plus(F.lit(1), amount.isNotNull()).alias("_priced"),
            plus(F.lit(1), F.col("is_high_value")).alias("high_value_orders"), when(added, F.max).alias("max_in"), when(added, F.min).alias("min_in"),
            when(gone, F.max).alias("max_out"), when(gone, F.min).alias("min_out")).withColumn("bucket", bucket_of("customer_hub_key", self.buckets)), "bought-changes")
        buckets = values_of(change, "bucket")
        was = self.bought.read(buckets)
        sums = ("lifetime_orders", "lifetime_gross", "lifetime_paid", "_priced", "high_value_orders")
        both = was.drop("bucket").join(change.withColumnsRenamed({c: f"d_{c}" for c in sums}).drop("bucket"), "customer_hub_key", "full")
        nil = lambda c: F.coalesce(F.col(c), F.lit(0))
        # The least or greatest time went away with an old row: it is looked up again, for these customers only.
        lost = (F.col("max_out") >= F.col("last_order_ts")) | (F.col("min_out") <= F.col("first_order_ts"))
        merged = written(both.select(
            "customer_hub_key", *[(nil(c) + nil(f"d_{c}")).alias(c) for c in sums], F.greatest("last_order_ts", "max_in").alias("last_order_ts"),
            F.least("first_order_ts", "min_in").alias("first_order_ts"), F.coalesce(lost, F.lit(False)).alias("lost"))
            .filter("lifetime_orders > 0").withColumn("bucket", bucket_of("customer_hub_key", self.buckets)), "bought-states")
        again = merged.filter("lost").select("customer_hub_key")
        days = self.customer_days.read(values_of(merged.filter("lost"), "bucket")).join(again, "customer_hub_key", "left_semi")
        periods = [*values_of(self._dated(days, "order_date"), "period"), NO_DATE]
        seen = (self.orders.read(periods).join(again, "customer_hub_key", "left_semi").groupBy("customer_hub_key")
                .agg(F.max("order_ts").alias("_last"), F.min("order_ts").alias("_first")))
        kept = lambda c, found: F.when(F.col("lost"), F.col(found)).otherwise(F.col(c)).alias(c)
        rows = merged.join(seen, "customer_hub_key", "left").select(
            "customer_hub_key", *sums, kept("last_order_ts", "_last"), kept("first_order_ts", "_first"), "bucket")
        return buckets, rows

    def _per_order(self, payments: DataFrame) -> DataFrame:
        status = F.col("status")
        return payments.groupBy("order_hub_key").agg(
            sum_where(status == "success", F.col("amount")).alias("paid"), flag_count(status == "success").alias("good"),
            flag_count(status == "failed").alias("bad"))

    def _add_paid(self, old: DataFrame, new: DataFrame) -> None:
        """``old`` and ``new``: (customer_hub_key, paid, good, bad) per order that counts no longer, or now."""
        change = written(signed(old, new).filter("customer_hub_key IS NOT NULL").groupBy("customer_hub_key").agg(
            F.sum(F.col("sign") * F.coalesce("paid", F.lit(0))).cast("decimal(34,2)").alias("lifetime_payments"),
            F.sum(F.col("sign") * F.col("good")).alias("successful_payments"), F.sum(F.col("sign") * F.col("bad")).alias("failed_payments"),
            F.sum("sign").alias("orders")).withColumn("bucket", bucket_of("customer_hub_key", self.buckets)), "paid-changes")
        buckets = values_of(change, "bucket")
        merged = self.paid.read(buckets).unionByName(change).groupBy("customer_hub_key", "bucket").agg(
            F.sum("lifetime_payments").cast("decimal(34,2)").alias("lifetime_payments"), F.sum("successful_payments").alias("successful_payments"),
            F.sum("failed_payments").alias("failed_payments"), F.sum("orders").alias("orders"))
        self.paid.replace(buckets, merged.filter("orders > 0"))

    def _move_payments(self, keys: DataFrame, places: DataFrame, new: DataFrame) -> None:
        """Orders that changed their customer, or came after their payments, take their payments along."""
        paid = self._per_order(self.payments.read(values_of(new, "bucket")).join(keys, "order_hub_key", "left_semi"))
        measures = ("customer_hub_key", "paid", "good", "bad")
        before = places.join(keys, "order_hub_key", "left_semi").join(paid, "order_hub_key").select(*measures)
        self._add_paid(before, new.join(paid, "order_hub_key").select(*measures))

    def load_payments(self, changed: DataFrame) -> None:
        """Takes the present rows of new and corrected payments, one per payment, with their order; payments stay with their order."""
        new = written(changed.filter("order_hub_key IS NOT NULL").select(
            "payment_hub_key", "order_hub_key", F.col("amount").cast("decimal(14,2)").alias("amount"), "status",
            bucket_of("order_hub_key", self.buckets)), "changed-payments")
        buckets, orders = values_of(new, "bucket"), new.select("order_hub_key").distinct()
        there = self.payments.read(buckets)
        after = written(there.join(new.select("order_hub_key", "payment_hub_key"), ["order_hub_key", "payment_hub_key"], "left_anti").unionByName(new), "payments-after")
        owners = self.places.read(buckets).select("order_hub_key", "customer_hub_key")

        def owned(payments: DataFrame) -> DataFrame:
            mine = self._per_order(payments.join(orders, "order_hub_key", "left_semi"))
            return mine.join(owners, "order_hub_key").select("customer_hub_key", "paid", "good", "bad")

        self._add_paid(owned(there), owned(after))
        self.payments.replace(buckets, after)

    # --- results -----------------------------------------------------------------------------

    def fct_orders(self) -> DataFrame:
        return self.orders.read().drop("period")

    def fct_daily_sales(self) -> DataFrame:
        return self.sales.read().drop("period")

    def agg_daily_sales(self) -> DataFrame:
        return self.moving.read().drop("period")

    def mart_daily_business_kpis(self) -> DataFrame:
        return self.kpis.read().drop("period")

    def mart_cohort_retention(self) -> DataFrame:
        return marts.cohort_rates(self.cohorts.read())

    def mv_customer_360(self, customers: DataFrame) -> DataFrame:
        """Attributes of ``customers`` with the kept states; no order and no payment is read."""
        return serving.customer_view(customers, self.bought.read().drop("bucket"), self.paid.read().drop("bucket", "orders"))

    def rebuild(self) -> None:
        """Derived tables and states anew from the kept facts and payments."""
        orders, payments = written(self.orders.read(), "all-orders"), written(self.payments.read(), "all-payments")
        for table in (self.sales, self.moving, self.kpis, self.cohorts, self.places, self.customer_days, self.bought, self.paid, self.orders, self.payments):
            table.replace(values_of(table.read(), table.by), table.read().limit(0))
        self.load(orders.drop("period"))
        self.load_payments(payments)
