"""Rules every build must keep; each function returns the violating rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.merge import rows_without_match
from ..operators.ordered import Series, with_neighbours, with_running_max

_INTERVAL = ("hub_key", "effective_from", "effective_to")
_INTERVALS = Series(("hub_key",), "effective_from", ("effective_to",))


def gaps(sat: DataFrame) -> DataFrame:
    """Versions that do not end where the next one starts."""
    rows = with_neighbours(sat.select(*_INTERVAL), _INTERVALS, following={"next_from": "effective_from"})
    return rows.filter(F.col("next_from").isNotNull() & ~F.col("effective_to").eqNullSafe(F.col("next_from")))


def overlaps(sat: DataFrame) -> DataFrame:
    """Versions that start before an earlier version of the key has ended.

    A version overlaps some earlier one exactly when it starts before the latest end seen
    so far, which needs one ordered pass instead of comparing all pairs of a key.
    """
    far = F.lit("9999-12-31").cast("timestamp_ntz")
    ends = sat.select(*_INTERVAL).withColumn("_end", F.coalesce(F.col("effective_to").cast("timestamp_ntz"), far))
    rows = with_running_max(ends, _INTERVALS, "latest_end", "_end")
    return rows.filter(F.col("latest_end") > F.col("effective_from").cast("timestamp_ntz")).drop("_end")


def pit_violations(pit: DataFrame, sat: DataFrame, alias: str) -> DataFrame:
    """Pointers to a version that does not exist or is not valid at the end of the day."""
    pointed = pit.select("hub_key", "as_of_date", F.col(f"{alias}_load_dts").alias("load_dts"),
                         F.col(f"{alias}_effective_from").alias("effective_from")).dropna(subset=["load_dts"])
    versions = sat.select("hub_key", "load_dts", "effective_from", "effective_to", F.lit(True).alias("_found"))
    day_end = F.col("as_of_date").cast("timestamp_ntz") + F.expr("interval 1 day") - F.expr("interval 1 second")
    start, end = F.col("effective_from").cast("timestamp_ntz"), F.col("effective_to").cast("timestamp_ntz")
    joined = pointed.join(versions, ["hub_key", "load_dts", "effective_from"], "left")
    wrong = F.col("_found").isNull() | (start > day_end) | (end.isNotNull() & (end <= day_end))
    return joined.filter(wrong).drop("_found")


def bridge_violations(bridge: DataFrame, link: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bridge rows without the link row they were made from."""
    return rows_without_match(bridge, link, keys)


def payment_state_violations(orders: DataFrame) -> DataFrame:
    state = F.coalesce("payment_state", F.lit("unpaid"))
    return orders.filter(F.col("has_successful_payment") & ~state.isin("fully_paid", "partially_paid")).select(
        "order_hub_key", "has_successful_payment", "payment_state")


SEGMENTS = ("platinum", "gold", "silver", "bronze")


def segment_violations(customers: DataFrame) -> DataFrame:
    return customers.filter(F.col("customer_segment").isNotNull() & ~F.col("customer_segment").isin(*SEGMENTS))


def negative_prices(products: DataFrame) -> DataFrame:
    return products.filter(F.col("price") < 0)


def rates_outside_unit(performance: DataFrame) -> DataFrame:
    return performance.filter(~F.col("success_rate").between(0, 1))
