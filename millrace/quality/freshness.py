"""Source freshness and layer row counts."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Freshness:
    column: str = "ingested_at"
    warn_minutes: int = 60
    error_minutes: int = 240


# Thresholds in minutes per kind of source.
KAFKA = Freshness(warn_minutes=15, error_minutes=60)
OLTP = Freshness(warn_minutes=30, error_minutes=120)
STAGED = Freshness(warn_minutes=30, error_minutes=90)
FILES = Freshness(warn_minutes=60, error_minutes=240)
EXTENSION = Freshness(warn_minutes=60, error_minutes=180)


def freshness(tables: Mapping[str, tuple[DataFrame, Freshness]], now: datetime) -> DataFrame:
    """Age of the newest row per table; an empty table is an error."""
    def one(name: str, df: DataFrame, rule: Freshness) -> DataFrame:
        clock = F.lit(now).cast(df.schema[rule.column].dataType)
        age = F.timestamp_diff("MINUTE", F.col("newest"), clock)
        status = F.when(F.col("newest").isNull() | (age > rule.error_minutes), "error").when(
            age > rule.warn_minutes, "warn").otherwise("pass")
        return df.agg(F.max(rule.column).alias("newest")).select(
            F.lit(name).alias("table_name"), "newest", age.alias("age_minutes"), status.alias("status"))

    return reduce(DataFrame.unionByName, [one(n, df, rule) for n, (df, rule) in tables.items()])


def layer_counts(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Rows before and after a step per table, and what that means.

    Rows in and none out is a failure, none in is a warning.
    """
    def count(df: DataFrame, name: str, side: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("table_name"), F.lit(side).alias("side"), "n")

    counted = reduce(DataFrame.unionByName, [count(df, name, side) for name, both in pairs.items()
                                             for df, side in zip(both, ("raw", "staged"))])
    wide = counted.groupBy("table_name").agg(
        F.max(F.when(F.col("side") == "raw", F.col("n"))).alias("raw_rows"),
        F.max(F.when(F.col("side") == "staged", F.col("n"))).alias("staged_rows"))
    verdict = F.when((F.col("raw_rows") > 0) & (F.col("staged_rows") == 0), "fail").when(
        F.col("raw_rows") == 0, "warn").otherwise("pass")
    return wide.withColumn("verdict", verdict)


def offenders(counts: DataFrame) -> DataFrame:
    """Names of all failing tables in one text; input has one row per configured table."""
    failing = counts.filter(F.col("verdict") == "fail")
    return failing.agg(F.count(F.lit(1)).alias("failing"),
                       F.array_join(F.sort_array(F.collect_list("table_name")), ", ").alias("tables"))
