"""Writing the layers of the warehouse: views, full refreshes, stored violations."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..quality.checks import CheckSpec, failing_rows


def create_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def full_refresh(df: DataFrame, path: str, cluster_by: str | None = None) -> None:
    """Replaces a table. ``cluster_by`` sorts rows into files by range, so that a filter on the
    column (a look-back window, a dashboard period) skips most files by their statistics."""
    rows = df.repartitionByRange(cluster_by).sortWithinPartitions(cluster_by) if cluster_by else df
    rows.write.mode("overwrite").parquet(path)


def append_delta(df: DataFrame, path: str) -> None:
    """Insert-only tables: only the new rows are written."""
    df.write.mode("append").parquet(path)


def stamped(df: DataFrame, now: datetime, column: str = "mart_load_dts") -> DataFrame:
    """Adds the run stamp; it belongs to the written table and not to the computed result."""
    return df.withColumn(column, F.lit(now))


def store_failures(specs: Iterable[CheckSpec], tables: Mapping[str, DataFrame], folder: str) -> list[str]:
    """Writes the violating rows of every check that has any form of them; returns the paths."""
    paths = []
    for spec in specs:
        if spec.type != "min_row_count":
            path = f"{folder}/{spec.name}"
            failing_rows(spec, tables).write.mode("overwrite").parquet(path)
            paths.append(path)
    return paths
