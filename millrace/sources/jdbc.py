"""Relational sources and sinks over JDBC."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Options = dict[str, str]


def read_table(spark: SparkSession, url: str, table: str, options: Options, *, split_on: str | None = None,
               bounds: tuple[int, int] | None = None, partitions: int = 32) -> DataFrame:
    """Reads a table in parallel slices of ``split_on``; without it through one connection."""
    if split_on is None or bounds is None:
        return spark.read.jdbc(url, table, properties=options)
    return spark.read.jdbc(url, table, column=split_on, lowerBound=bounds[0], upperBound=bounds[1],
                           numPartitions=partitions, properties=options)


def read_dates(spark: SparkSession, url: str, table: str, options: Options, column: str, start: date,
               end: date) -> DataFrame:
    """A range of days; the filter is evaluated by the database."""
    return spark.read.jdbc(url, table, properties=options).filter(F.col(column).between(F.lit(start), F.lit(end)))


def first_readable(spark: SparkSession, *candidates: tuple[str, dict[str, str]]) -> DataFrame:
    """First existing catalog table, columns renamed (new name -> column) to one shape."""
    for table, columns in candidates:
        if spark.catalog.tableExists(table):
            return spark.table(table).select(*[F.col(c).alias(n) for n, c in columns.items()])
    raise RuntimeError("none of the tables exists: " + ", ".join(t for t, _ in candidates))


def append(df: DataFrame, url: str, table: str, options: Options) -> None:
    df.write.mode("append").jdbc(url, table, properties={"batchsize": "1000", **options})


def replace(df: DataFrame, url: str, table: str, options: Options) -> None:
    """Empties the table and fills it again, keeping its definition."""
    df.write.mode("overwrite").option("truncate", True).jdbc(url, table, properties={"batchsize": "1000", **options})
