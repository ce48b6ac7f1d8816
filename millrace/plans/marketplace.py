"""Analytics over the marketplace event feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.measures import ratio, rounded_ratio
from ..operators.ordered import Series, with_neighbours


def campaign_ratios(performance: DataFrame) -> DataFrame:
    """Totals and ratios per campaign and day."""
    days = performance.groupBy("campaign_id", "report_date").agg(
        *[F.sum(c).alias(c) for c in ("impressions", "clicks", "conversions")],
        *[F.sum(c).cast("decimal(24,2)").alias(c) for c in ("revenue", "spend")])
    clicks, spend = F.col("clicks"), F.col("spend")
    return days.withColumns({
        "ctr": rounded_ratio(clicks, F.col("impressions"), 4), "cpc": rounded_ratio(spend, clicks, 2),
        "cpa": rounded_ratio(spend, F.col("conversions"), 2), "roas": rounded_ratio(F.col("revenue"), spend, 2)})


# Upper bounds of the rank buckets.
RANK_BUCKETS = (("top_3", 3), ("top_10", 10), ("top_20", 20), ("top_50", 50))


def rank_bucket(position: Column) -> Column:
    rule = None
    for name, bound in RANK_BUCKETS:
        rule = F.when(position <= bound, name) if rule is None else rule.when(position <= bound, name)
    return rule.otherwise("beyond")


def rank_changes(ranks: DataFrame) -> DataFrame:
    """Position against the previous ranking of the keyword."""
    series = Series(("keyword_id",), "rank_date")
    rows = with_neighbours(ranks, series, previous={"previous_position": "position"})
    return rows.withColumns({
        "position_change": F.col("position") - F.col("previous_position"), "bucket": rank_bucket(F.col("position"))})


VITALS = ("lcp", "fid", "cls")


def web_vitals_p95(vitals: DataFrame, accuracy: int = 10000) -> DataFrame:
    """95th percentile of each vital per hour from a sketch that merges on the map side."""
    return vitals.groupBy(_hour().alias("hour")).agg(F.count(F.lit(1)).alias("samples"), *[
        F.percentile_approx(name, F.lit(0.95), F.lit(accuracy)).alias(f"{name}_p95") for name in VITALS])


def web_vitals_p95_exact(vitals: DataFrame) -> DataFrame:
    """The same from counts per measured value, interpolated between neighbours. Equal values are counted before anything is exchanged."""
    long = vitals.select(_hour().alias("hour"), F.explode(F.array(*[
        F.struct(F.lit(n).alias("vital"), F.col(n).alias("value")) for n in VITALS])).alias("v"))
    counted = long.groupBy("hour", "v.vital", "v.value").agg(F.count(F.lit(1)).alias("n"))
    p95 = counted.groupBy("hour", "vital").agg(
        F.sum("n").alias("samples"), F.round(F.percentile("value", F.lit(0.95), F.col("n")), 6).alias("p95"))
    return p95.groupBy("hour").agg(F.max("samples").alias("samples"), *[
        F.max(F.when(F.col("vital") == n, F.col("p95"))).alias(f"{n}_p95") for n in VITALS])


def _hour() -> Column:
    return F.date_trunc("hour", "metric_ts").cast("timestamp_ntz")


def orders_by_country(events: DataFrame) -> DataFrame:
    return events.groupBy("country_code").agg(F.count(F.lit(1)).alias("orders"))


def order_events(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Order events as they are sent: the order's total with the array of its items, in line order."""
    item = F.struct("line_number", "product_id", "quantity", "unit_price")
    items = lines.groupBy("order_id").agg(F.sort_array(F.collect_list(item)).alias("items"))
    return items.join(orders.select("order_id", "total_amount"), "order_id")


def item_totals(events: DataFrame, discount: Column | None = None) -> DataFrame:
    """Order totals recomputed from the items, compared with the stated total less discount."""
    cut = F.lit(0).cast("decimal(14,2)") if discount is None else discount
    per_item = events.select("order_id", "total_amount", cut.alias("discount"), F.explode("items").alias("i")).select(
        "order_id", "total_amount", "discount",
        (F.col("i.quantity") * F.col("i.unit_price")).cast("decimal(18,2)").alias("subtotal"))
    sums = per_item.groupBy("order_id", "total_amount", "discount").agg(
        F.count(F.lit(1)).alias("item_count"), F.sum("subtotal").cast("decimal(24,2)").alias("items_total"))
    stated = F.col("total_amount") - F.col("discount")
    return sums.select("order_id", "total_amount", "item_count", "items_total",
                       (F.abs(F.col("items_total") - stated) < 0.01).alias("matches"))


def keyword_class(keyword: Column) -> Column:
    text = F.lower(keyword)
    return F.when(text.rlike("buy|price|cheap|deal"), "transactional").when(
        text.rlike("brand|store|official"), "navigational").when(
        text.rlike("how|what|why|guide"), "informational").otherwise("commercial")


def session_rates(sessions: DataFrame) -> DataFrame:
    """Bounce and conversion rate per landing page and class of keyword."""
    bounced = F.col("pages_viewed") <= 1
    grouped = sessions.groupBy("landing_page", keyword_class(F.col("keyword")).alias("keyword_class")).agg(
        F.count(F.lit(1)).alias("sessions"), F.count_if(bounced).alias("bounces"),
        F.count_if(F.col("conversion")).alias("conversions"),
        F.sum("revenue").cast("decimal(24,2)").alias("revenue"))
    return grouped.withColumns({"bounce_rate": ratio(F.col("bounces"), F.col("sessions")),
                                "conversion_rate": ratio(F.col("conversions"), F.col("sessions"))})


def worked_time(clock: DataFrame) -> DataFrame:
    """Seconds between each clock-in and a clock-out right after it, per employee and day."""
    series = Series(("employee_id",), "ts", ("event_id",))
    rows = with_neighbours(clock, series, following={"next_type": "event_type", "next_ts": "ts"})
    shifts = rows.filter((F.col("event_type") == "clock_in") & (F.col("next_type") == "clock_out"))
    return shifts.groupBy("employee_id", F.to_date("ts").alias("work_date")).agg(
        F.count(F.lit(1)).alias("shifts"),
        F.sum(F.timestamp_diff("SECOND", F.col("ts"), F.col("next_ts"))).alias("worked_seconds"))
