"""Ordered per-key computations that survive a key with any share of all rows.

A window over ``partitionBy(key)`` puts one key into one task. Here rows are dealt into segments by ranges of
(key, time, ties) and written once with the number of their segment, so a large key fills many segments and small keys
share one. The window runs per (segment, key). Only the last key of a segment can go on in the next one, so what crosses
the borders is one row per segment; that table, as long as the number of shuffle partitions, is carried along and
joined back. There is one plan for every size of a key, and no count beforehand.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import written

_SEGMENT = "_segment"
_BEFORE, _AFTER = "_before", "_after"


@dataclass(frozen=True)
class Series:
    """Rows of one key in time order; ``time`` leads the order, ``ties`` complete it to a total order."""

    keys: tuple[str, ...]
    time: str
    ties: tuple[str, ...] = ()

    @property
    def order(self) -> list[Column]:
        return [F.col(c).asc() for c in (self.time, *self.ties)]

    def key(self) -> Column:
        return F.struct(*self.keys)

    def position(self) -> Column:
        """Place of a row among all rows of all keys."""
        return F.struct(*self.keys, self.time, *self.ties)

    def local(self):
        """Window over the rows of one key in one segment."""
        return W.partitionBy(_SEGMENT, *self.keys).orderBy(*self.order)

    def ordered_by(self, time: str, ties: tuple[str, ...]) -> Series:
        return replace(self, time=time, ties=ties)


def segmented(df: DataFrame, series: Series) -> DataFrame:
    """``df`` in ranges of (key, time, ties), written, with a column that numbers the ranges.

    The functions below keep that column where their input has it, so a chain of steps in one order is dealt out once;
    a step in between may drop rows. Drop the column with :func:`unsegmented`.
    """
    ranges = df.repartitionByRange(*[F.col(k).asc() for k in series.keys], *series.order)
    return written(ranges.withColumn(_SEGMENT, F.spark_partition_id()), "segments")


def unsegmented(df: DataFrame) -> DataFrame:
    return df.drop(_SEGMENT)


def _dealt(df: DataFrame, series: Series) -> tuple[DataFrame, list[str]]:
    """The frame with segments, and the columns that a result keeps."""
    return (df if _SEGMENT in df.columns else segmented(df, series)), df.columns


def _joined(rows: DataFrame, borders: DataFrame) -> DataFrame:
    """Adds the border columns; there is one row per segment, and as many segments as shuffle partitions at most."""
    return rows.join(F.broadcast(borders), _SEGMENT, "left")


def with_neighbours(df: DataFrame, series: Series, *, previous: Mapping[str, str] | None = None,
                    following: Mapping[str, str] | None = None) -> DataFrame:
    """Adds columns of the previous and the next row of the same key (new name -> column)."""
    previous, following = dict(previous or {}), dict(following or {})
    rows, kept = _dealt(df, series)
    named = lambda wanted: F.struct(series.key().alias("key"), *[F.col(c).alias(n) for n, c in wanted.items()])
    ends = rows.groupBy(_SEGMENT).agg(F.min_by(named(following), series.position()).alias("first"),
                                      F.max_by(named(previous), series.position()).alias("last"))
    across = W.orderBy(_SEGMENT)
    borders = ends.select(_SEGMENT, F.lag("last").over(across).alias(_BEFORE), F.lead("first").over(across).alias(_AFTER))
    window = series.local()
    local = rows.withColumns({
        **{n: F.lag(c).over(window) for n, c in previous.items()}, **{n: F.lead(c).over(window) for n, c in following.items()},
        "_head": F.lag(F.lit(1)).over(window).isNull(), "_tail": F.lead(F.lit(1)).over(window).isNull()})
    continued = lambda edge, side: F.col(edge) & F.col(side).isNotNull() & F.col(f"{side}.key").eqNullSafe(series.key())
    resolved = {n: F.when(continued("_head", _BEFORE), F.col(f"{_BEFORE}.{n}")).otherwise(F.col(n)) for n in previous}
    resolved |= {n: F.when(continued("_tail", _AFTER), F.col(f"{_AFTER}.{n}")).otherwise(F.col(n)) for n in following}
    return _joined(local, borders).withColumns(resolved).select(*kept, *previous, *following)


def _with_carry(rows: DataFrame, series: Series, of_key: Column, so_far) -> DataFrame:
    """Adds what earlier segments say about a row's key: ``of_key`` sums up a key in a segment, ``so_far`` adds segments up."""
    keys = rows.groupBy(_SEGMENT, series.key().alias("_key")).agg(of_key.alias("_value"))
    last = keys.groupBy(_SEGMENT).agg(F.max_by(F.struct("_key", "_value"), F.col("_key")).alias("_end"))
    within = W.partitionBy("_end._key").orderBy(_SEGMENT).rowsBetween(W.unboundedPreceding, W.currentRow)
    summed = last.select(_SEGMENT, F.struct(F.col("_end._key").alias("key"), so_far(F.col("_end._value")).over(within).alias("value")).alias("_sum"))
    borders = summed.select(_SEGMENT, F.lag("_sum").over(W.orderBy(_SEGMENT)).alias(_BEFORE))
    goes_on = F.col(_BEFORE).isNotNull() & F.col(f"{_BEFORE}.key").eqNullSafe(series.key())
    return _joined(rows, borders).withColumn(_BEFORE, F.when(goes_on, F.col(f"{_BEFORE}.value")))


def with_last_known(df: DataFrame, series: Series, name: str, value: str) -> DataFrame:
    """Adds the last non-NULL ``value`` of the same key up to and including the current row."""
    rows, kept = _dealt(df, series)
    here = F.last(value, ignorenulls=True).over(series.local().rowsBetween(W.unboundedPreceding, W.currentRow))
    newest = F.max_by(F.col(value), F.when(F.col(value).isNotNull(), series.position()))
    carried = _with_carry(rows, series, newest, lambda c: F.last(c, ignorenulls=True))
    return carried.withColumn(name, F.coalesce(here, F.col(_BEFORE))).select(*kept, name)


def with_running_max(df: DataFrame, series: Series, name: str, value: str) -> DataFrame:
    """Adds the maximum of ``value`` over all earlier rows of the same key."""
    rows, kept = _dealt(df, series)
    here = F.max(value).over(series.local().rowsBetween(W.unboundedPreceding, -1))
    carried = _with_carry(rows, series, F.max(value), F.max)
    return carried.withColumn(name, F.greatest(here, F.col(_BEFORE))).select(*kept, name)
