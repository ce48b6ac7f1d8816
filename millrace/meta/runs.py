"""Run log of the pipelines and the views over it."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.measures import flag_count
from ..functions.payloads import merge_json
from ..operators.merge import rows_without_match

SCHEMA = ("run_id string, dag_id string, task_id string, source string, layer string, status string, "
          "started_at timestamp, finished_at timestamp, rows_in bigint, rows_out bigint, rows_quarantined bigint, "
          "error_message string, payload string")

_FINAL = ("status", "finished_at", "rows_in", "rows_out", "rows_quarantined", "error_message")


_NAMES = ("run_id", "dag_id", "task_id", "source", "layer")


def start(log: DataFrame, starting: DataFrame, now: datetime) -> DataFrame:
    """Run log after runs began: a row without outcome for every run of ``starting`` (run_id, dag_id, task_id, source, layer, payload).

    A run that the log holds already stays as it is, so a repeated start changes nothing.
    """
    new = rows_without_match(starting.dropDuplicates(["run_id"]), log, ["run_id"])
    opened = new.select(*_NAMES, F.lit("running").alias("status"), F.lit(now).cast(log.schema["started_at"].dataType).alias("started_at"),
                        F.coalesce("payload", F.lit("{}")).alias("payload"))
    return log.unionByName(opened, allowMissingColumns=True)


def finish(started: DataFrame, finished: DataFrame) -> DataFrame:
    """Run log after runs ended: outcome columns replaced, payload fields merged."""
    ends = finished.select("run_id", *[F.col(c).alias(f"_f_{c}") for c in _FINAL],
                           F.col("payload").alias("_f_payload"), F.lit(True).alias("_ended"))
    rows = started.join(ends, "run_id", "left")
    outcome = {c: F.when(F.col("_ended"), F.col(f"_f_{c}")).otherwise(F.col(c)) for c in _FINAL}
    payload = F.when(F.col("_ended"), merge_json(F.col("payload"), F.col("_f_payload"))).otherwise(F.col("payload"))
    return rows.withColumns({**outcome, "payload": payload}).select(*started.columns)


def _seconds(start: str, end) -> F.Column:
    return F.timestamp_diff("SECOND", F.col(start), end)


def _recent(runs: DataFrame, now: datetime, days: int = 7) -> DataFrame:
    return runs.filter(F.col("started_at") >= F.lit(now - timedelta(days=days)))


def recent_runs(runs: DataFrame, now: datetime) -> DataFrame:
    clock = F.lit(now).cast(runs.schema["finished_at"].dataType)
    return _recent(runs, now).select(
        "run_id", "dag_id", "task_id", "source", "layer", "status", "started_at", "finished_at",
        _seconds("started_at", F.coalesce("finished_at", clock)).alias("duration_seconds"),
        "rows_in", "rows_out", "rows_quarantined", "error_message")


def run_summary(runs: DataFrame, now: datetime) -> DataFrame:
    return _recent(runs, now).groupBy("dag_id", "layer").agg(
        flag_count(F.col("status") == "success").alias("runs_success"),
        flag_count(F.col("status") == "failed").alias("runs_failed"),
        F.coalesce(F.sum("rows_in"), F.lit(0)).alias("total_rows_in"),
        F.coalesce(F.sum("rows_out"), F.lit(0)).alias("total_rows_out"),
        F.max("finished_at").alias("last_finished_at"))


def success_ratio(summary: DataFrame) -> DataFrame:
    good, bad = F.sum("runs_success"), F.sum("runs_failed")
    return summary.agg(F.coalesce(F.try_divide(good.cast("double"), (good + bad).cast("double")), F.lit(0.0))
                       .alias("ratio"))


def runs_over_time(runs: DataFrame, now: datetime) -> DataFrame:
    return runs.filter(F.col("started_at") >= F.lit(now - timedelta(hours=24))).groupBy(
        F.col("started_at").alias("time"), F.col("status").alias("metric")).agg(
        F.count(F.lit(1)).cast("double").alias("value"))


def state_counts(runs: DataFrame, now: datetime) -> DataFrame:
    return _recent(runs, now).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def longest_runs(runs: DataFrame, now: datetime, top: int = 20) -> DataFrame:
    ended = _recent(runs, now).filter(F.col("finished_at").isNotNull())
    return ended.select("dag_id", "run_id", "status", "started_at", "finished_at",
                        _seconds("started_at", F.col("finished_at")).alias("duration_sec")).orderBy(
        F.col("duration_sec").desc_nulls_last(), F.col("started_at").desc(), F.col("run_id")).limit(top)


def latest_failures(runs: DataFrame, now: datetime, top: int = 30) -> DataFrame:
    return _recent(runs, now).filter(F.col("status") == "failed").select(
        "dag_id", "run_id", "started_at", "finished_at").orderBy(
        F.col("started_at").desc(), F.col("run_id")).limit(top)


def latest_rows(table: DataFrame, stamp: str, tie: str, top: int = 50) -> DataFrame:
    """Newest rows of a metadata table (runs, watermarks, check results)."""
    return table.orderBy(F.col(stamp).desc_nulls_last(), F.col(tie)).limit(top)


def recent_results(results: DataFrame, now: datetime) -> DataFrame:
    return results.filter(F.col("checked_at") >= F.lit(now - timedelta(days=7)))
