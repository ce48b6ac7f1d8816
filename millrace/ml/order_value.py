"""Order value regression: training frame, pipeline, metrics."""

from __future__ import annotations

import math
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import FeatureHasher, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written


@dataclass(frozen=True)
class TrainingSpec:
    days: int = 365
    train_ratio: float = 0.8
    seed: int = 42
    max_iter: int = 40
    max_depth: int = 5
    step_size: float = 0.1
    min_rows: int = 50
    customer_buckets: int = 256
    """Columns that customers are hashed into, however many there are."""


def training_frame(orders: DataFrame, now: datetime, spec: TrainingSpec) -> DataFrame:
    """Features and label; ``in_training`` is decided by a hash of the order key, so a row is on one side in every run."""
    recent = orders.filter(F.col("order_ts") >= F.lit(now - timedelta(days=spec.days))).dropna(
        subset=["order_ts", "total_amount"])
    draw = F.pmod(F.xxhash64(F.lit(spec.seed), F.col("order_bk").cast("string")), F.lit(1 << 20))
    return recent.select(
        "status", "currency", "customer_bk", F.hour("order_ts").alias("order_hour"),
        F.dayofweek("order_ts").alias("order_dayofweek"), F.col("total_amount").cast("double").alias("label"),
        (draw < int(spec.train_ratio * (1 << 20))).alias("in_training")
    ).filter(F.col("label") > 0)


#: Rows that a task trains on. Training keeps a row as a number per feature, about a kilobyte.
TASK_ROWS = 200_000


def spread(rows: DataFrame, n: int) -> DataFrame:
    """``n`` rows in parts of ``TASK_ROWS`` or less; few rows stay as they are."""
    parts = math.ceil(n / TASK_ROWS)
    return rows.repartition(parts) if parts > rows.rdd.getNumPartitions() else rows


def points_of(rows: DataFrame) -> DataFrame:
    """Rows (features, label) with equal features as one row: the mean of their labels, and their number as weight.

    Splits and leaves of a tree on squared errors follow from sums and counts of labels, and rows with equal features never part, so
    weighted means give the trees that the rows give. Features are few indexes, an hour, a weekday and a customer column, so their
    combinations do not grow with the rows.
    """
    return rows.groupBy("features").agg(F.avg("label").alias("label"), F.count(F.lit(1)).cast("double").alias("weight"))


def fitted(spec: TrainingSpec, rows: DataFrame, n: int) -> PipelineModel:
    """The pipeline trained on ``n`` rows. Trees read their rows some hundred times, so rows beyond a task's are put together first."""
    pipeline = build_pipeline(spec)
    if n <= TASK_ROWS:
        return pipeline.fit(spread(rows, n))
    *stages, trees = pipeline.getStages()
    prepared = Pipeline(stages=stages).fit(rows)
    points = written(points_of(prepared.transform(rows)), "training-points")
    return PipelineModel([*prepared.stages, trees.setWeightCol("weight").fit(spread(points, points.count()))])


def build_pipeline(spec: TrainingSpec) -> Pipeline:
    """Few-valued texts are indexed, customers hashed."""
    stages = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep") for c in ("status", "currency")]
    stages.append(FeatureHasher(inputCols=["customer_bk"], outputCol="customer_vec", numFeatures=spec.customer_buckets))
    inputs = ["status_idx", "currency_idx", "order_hour", "order_dayofweek", "customer_vec"]
    model = GBTRegressor(featuresCol="features", labelCol="label", maxIter=spec.max_iter, maxDepth=spec.max_depth,
                         stepSize=spec.step_size, seed=spec.seed)
    return Pipeline(stages=[*stages, VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep"), model])


def metrics_of(scored: DataFrame) -> dict[str, float | None]:
    """Root mean squared error, mean absolute error and r2 in one pass."""
    error = F.col("label") - F.col("prediction")
    row = scored.agg(F.sqrt(F.avg(error * error)).alias("rmse"), F.avg(F.abs(error)).alias("mae"),
                     F.try_divide(F.sum(error * error), F.var_pop("label") * F.count("label")).alias("unexplained")).first()
    return {"rmse": row["rmse"], "mae": row["mae"], "r2": None if row["unexplained"] is None else 1 - row["unexplained"]}


def train(orders: DataFrame, now: datetime, spec: TrainingSpec = TrainingSpec()) -> tuple[PipelineModel, DataFrame]:
    """Fitted model and a one-row frame of sizes, metrics and parameters."""
    frame = written(training_frame(orders, now, spec), "training")
    size = frame.agg(F.count(F.lit(1)).alias("rows"), F.count_if("in_training").alias("train_rows")).first()
    if size["rows"] < spec.min_rows:
        raise ValueError(f"{size['rows']} rows are too few to train on")
    model = fitted(spec, frame.filter("in_training"), size["train_rows"])
    values = metrics_of(model.transform(frame.filter("NOT in_training")))
    row = {"rows": size["rows"], "train_rows": size["train_rows"], "max_iter": spec.max_iter, "max_depth": spec.max_depth, **values}
    schema = "rows bigint, train_rows bigint, max_iter int, max_depth int, rmse double, mae double, r2 double"
    return model, frame.sparkSession.createDataFrame([tuple(row.values())], schema)


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)
