"""Business rules as column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower bounds of yearly spend bands, highest first.
SEGMENT_BOUNDS = (("platinum", 5000), ("gold", 1000), ("silver", 200))
LOWEST_SEGMENT = "bronze"
HIGH_VALUE_FROM = 1000
PAID_TOLERANCE = 0.01


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double quotient; NULL when the denominator is NULL or 0."""
    return F.when(denominator != 0, numerator.cast("double") / denominator.cast("double"))


def rounded_ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """Quotient rounded half up from exact DECIMALs, 0 when the denominator is NULL or 0."""
    exact = numerator.cast("decimal(24,2)") / F.nullif(denominator.cast("decimal(24,2)"), F.lit(0))
    return F.coalesce(F.round(exact, digits).cast("double"), F.lit(0.0))


def mean_of(total: Column, count: Column) -> Column:
    """Average from an exact DECIMAL total, so the result does not depend on row order."""
    return ratio(total, count)


def segment(spend: Column) -> Column:
    rule = None
    for name, bound in SEGMENT_BOUNDS:
        rule = F.when(spend >= bound, name) if rule is None else rule.when(spend >= bound, name)
    return rule.otherwise(LOWEST_SEGMENT)


def payment_state(succeeded: Column, paid: Column, total: Column) -> Column:
    close = F.abs(F.coalesce(paid, F.lit(0)) - total) < F.lit(PAID_TOLERANCE).cast("decimal(4,2)")
    return F.when(succeeded & close, "fully_paid").when(succeeded, "partially_paid").otherwise("unpaid")


def is_success(status: Column, accepted: Iterable[str] = ("success",)) -> Column:
    return F.lower(status).isin(list(accepted))


def flag_count(condition: Column) -> Column:
    """Number of rows that meet a condition, 0 for an empty group."""
    return F.count(F.when(condition, F.lit(1)))


def sum_where(condition: Column, value: Column) -> Column:
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))
