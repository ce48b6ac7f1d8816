"""Configured data-quality checks with one result row each.

Checks that look at one row at a time are evaluated together, one aggregation per table,
so a table is scanned once however many columns are checked.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F


@dataclass(frozen=True)
class CheckSpec:
    name: str
    table: str
    type: str
    severity: str = "error"
    columns: tuple[str, ...] = ()
    min_value: float | None = None
    max_value: float | None = None
    values: tuple[str, ...] = ()
    predicate: str | None = None
    where: str | None = None
    parent_table: str | None = None
    parent_column: str | None = None
    null_child: str = "orphan"
    current: str = "at_most_one"
    min_rows: int = 1


RESULT_SCHEMA = ("check_name string, table_name string, severity string, passed boolean, observed_value string, "
                 "expected_value string, error string, checked_at timestamp")


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def broken_row(spec: CheckSpec) -> Column:
    """True for rows that break a row-level check."""
    columns = [F.col(c) for c in spec.columns]
    if spec.type == "not_null":
        broken = _any([c.isNull() for c in columns])
    elif spec.type == "range":
        low = [c < spec.min_value for c in columns] if spec.min_value is not None else []
        high = [c > spec.max_value for c in columns] if spec.max_value is not None else []
        broken = _any(low + high)
    elif spec.type == "non_negative":
        broken = _any([c < 0 for c in columns])
    elif spec.type == "accepted_values":
        broken = _any([~c.isin(list(spec.values)) for c in columns])
    elif spec.type == "predicate":
        broken = F.expr(spec.predicate)
    else:
        raise ValueError(f"unknown check type: {spec.type}")
    return broken & F.expr(spec.where) if spec.where else broken


ROW_CHECKS = ("not_null", "range", "non_negative", "accepted_values", "predicate")
GROUP_CHECKS = ("unique", "referential", "scd2_one_current", "min_row_count")


def _restricted(df: DataFrame, spec: CheckSpec) -> DataFrame:
    return df.filter(F.expr(spec.where)) if spec.where else df


def duplicates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") > 1)


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str,
            null_child: str = "orphan") -> DataFrame:
    """Child rows without a parent; a NULL reference counts as one unless it is to be ignored."""
    if null_child == "ignore":
        child = child.filter(F.col(column).isNotNull())
    known = parent.select(F.col(parent_column).alias("_parent")).distinct()
    return child.join(known, child[column] == known["_parent"], "left_anti")


def wrong_current(sat: DataFrame, key: str = "hub_key", mode: str = "at_most_one") -> DataFrame:
    """Keys with more than one current row, or (``exactly_one``) with any other number than one."""
    current = F.count(F.when(F.col("is_current"), F.lit(1)))
    counted = sat.groupBy(key).agg(current.alias("current_rows"))
    limit = F.col("current_rows") > 1 if mode == "at_most_one" else F.col("current_rows") != 1
    return counted.filter(limit)


def failing_rows(spec: CheckSpec, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The rows or keys to store for a failed check."""
    if spec.type in ROW_CHECKS:
        return tables[spec.table].filter(broken_row(spec))
    df = _restricted(tables[spec.table], spec)
    if spec.type == "unique":
        return duplicates(df, spec.columns)
    if spec.type == "referential":
        return orphans(df, spec.columns[0], tables[spec.parent_table], spec.parent_column, spec.null_child)
    if spec.type == "scd2_one_current":
        return wrong_current(df, spec.columns[0], spec.current)
    raise ValueError(f"unknown check type: {spec.type}")


_RESULT = ("check_name", "table_name", "severity", "passed", "observed_value", "expected_value")


def _result(spec: CheckSpec, observed: Column, passed: Column, expected: str) -> Column:
    values = (F.lit(spec.name), F.lit(spec.table), F.lit(spec.severity), passed, observed.cast("string"),
              F.lit(expected))
    return F.struct(*[v.alias(n) for v, n in zip(values, _RESULT)])


def _row_level(df: DataFrame, specs: Sequence[CheckSpec]) -> DataFrame:
    counts = [F.count_if(F.coalesce(broken_row(s), F.lit(False))).alias(f"_{i}") for i, s in enumerate(specs)]
    results = [_result(s, F.col(f"_{i}"), F.col(f"_{i}") == 0, "0") for i, s in enumerate(specs)]
    return df.agg(*counts).select(F.inline(F.array(*results)))


def _group_level(spec: CheckSpec, tables: Mapping[str, DataFrame]) -> DataFrame:
    n = F.col("_n")
    if spec.type == "min_row_count":
        counted = _restricted(tables[spec.table], spec).agg(F.count(F.lit(1)).alias("_n"))
        result = _result(spec, n, n >= spec.min_rows, f">={spec.min_rows}")
    else:
        counted = failing_rows(spec, tables).agg(F.count(F.lit(1)).alias("_n"))
        result = _result(spec, n, n == 0, "0")
    return counted.select(F.inline(F.array(result)))


def evaluate(specs: Sequence[CheckSpec], tables: Mapping[str, DataFrame]) -> DataFrame:
    """One result row per check."""
    by_table: dict[str, list[CheckSpec]] = {}
    frames = []
    for spec in specs:
        if spec.type in ROW_CHECKS:
            by_table.setdefault(spec.table, []).append(spec)
        elif spec.type in GROUP_CHECKS:
            frames.append(_group_level(spec, tables))
        else:
            raise ValueError(f"unknown check type: {spec.type}")
    frames += [_row_level(tables[t], group) for t, group in by_table.items()]
    return reduce(DataFrame.unionByName, frames)


def execute_checks(specs: Sequence[CheckSpec], tables: Mapping[str, DataFrame], now: datetime) -> DataFrame:
    """One row per check with its result, the time and, if it could not run, its error.

    All checks run together; only if that raises does each run on its own, so that one broken check fails alone. An
    unknown check type is a configuration error and raises before anything runs.
    """
    for spec in specs:
        if spec.type not in ROW_CHECKS + GROUP_CHECKS:
            raise ValueError(f"unknown check type: {spec.type}")
    spark = next(iter(tables.values())).sparkSession
    try:
        rows = [(*_outcome(r), None, now) for r in evaluate(specs, tables).collect()]
    except Exception:  # noqa: BLE001 - found again, and named, below
        rows = [_alone(spec, tables, now) for spec in specs]
    return spark.createDataFrame(rows, RESULT_SCHEMA)


def _outcome(row: Row) -> tuple:
    return tuple(row[c] for c in ("check_name", "table_name", "severity", "passed", "observed_value", "expected_value"))


def _alone(spec: CheckSpec, tables: Mapping[str, DataFrame], now: datetime) -> tuple:
    try:
        return (*_outcome(evaluate([spec], tables).first()), None, now)
    except Exception as problem:  # noqa: BLE001 - a broken check is a failed check
        return spec.name, spec.table, spec.severity, False, None, None, str(problem), now


def blocking(results: DataFrame, fail_on: Sequence[str] = ("error", "critical")) -> DataFrame:
    """Failed checks of a severity that stops a run."""
    return results.filter(~F.col("passed") & F.col("severity").isin(*fail_on))
