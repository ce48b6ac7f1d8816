"""Change streams: reading, applying and keeping them idempotent."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.payloads import change_rows, message_projection
from ..operators.latest import latest_by
from ..operators.scd2 import SatSpec, build_satellite
from ..sources.batches import BATCH, BatchLog

STATE = "ts_ms bigint, kafka_offset bigint, deleted boolean"


def change_state(messages: DataFrame, row_schema: str, keys: Sequence[str]) -> DataFrame:
    """Last known state per key: newest log time wins, then the highest offset."""
    changes = change_rows(messages, row_schema).filter(F.col("row").isNotNull()).select(
        "row.*", "ts_ms", "kafka_offset", (F.col("op") == "d").alias("deleted"))
    return newest_state(changes, keys)


def newest_state(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    return latest_by(states.dropna(subset=list(keys)), keys,
                     [F.col("ts_ms").desc_nulls_last(), F.col("kafka_offset").desc()])


def apply_changes(state: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """State after more changes, in whatever order and however often they arrive.

    Deleted keys stay as marked rows, so a change that arrives after its delete is not
    taken for a new row.
    """
    return newest_state(state.unionByName(changes), keys)


def live_rows(state: DataFrame) -> DataFrame:
    return state.filter(~F.col("deleted")).drop("ts_ms", "kafka_offset", "deleted")


def run_to_end(stream: DataFrame, checkpoint: str, batch: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Processes everything available in micro-batches and stops."""
    query = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(
        batch).start()
    query.awaitTermination()
    return query


def collect_changes(messages: DataFrame, log: BatchLog, row_schema: str, keys: Sequence[str], checkpoint: str) -> None:
    """Stores the last state per key of each micro-batch; :func:`newest_state` over the log is the state of all."""
    run_to_end(messages, checkpoint, lambda df, batch_id: log.put(change_state(df, row_schema, keys), batch_id))


def collect_rows(rows: DataFrame, log: BatchLog, checkpoint: str) -> None:
    """Stores the rows of each micro-batch as they are."""
    run_to_end(rows, checkpoint, lambda df, batch_id: log.put(df, batch_id))


def first_deliveries(log: BatchLog, keys: Sequence[str]) -> DataFrame:
    """One row per position: of a position that was delivered again, the earliest batch counts, then the least content."""
    rest = [c for c in log.schema.names if c not in keys]
    return latest_by(log.read(with_batch=True), keys, [F.col(BATCH).asc(), *[F.col(c).asc() for c in rest]]).drop(BATCH)


def satellite_of(log: BatchLog, spec: SatSpec) -> DataFrame:
    """The timeline of all observations in the log. Late ones fall into place, wherever the batches were cut."""
    return build_satellite(log.read(), spec)


def console_preview(stream: DataFrame, checkpoint: str, sink: str = "console", name: str = "preview") -> StreamingQuery:
    """Appends the raw message projection to the console (or a memory table)."""
    writer = message_projection(stream).writeStream.outputMode("append").format(sink).queryName(name)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def load_topics(loaders: dict[str, Callable[[], int]], min_success: int = 1) -> tuple[dict[str, int], dict[str, str]]:
    """Runs one loader per topic; raises only when fewer than ``min_success`` topics worked."""
    loaded: dict[str, int] = {}
    errors: dict[str, str] = {}
    for topic, load in loaders.items():
        try:
            loaded[topic] = load()
        except Exception as problem:  # noqa: BLE001 - the other topics still count
            errors[topic] = str(problem)
    if len(loaded) < min_success:
        raise RuntimeError(f"only {len(loaded)} of {len(loaders)} topics loaded: {errors}")
    return loaded, errors


def file_stream(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    """A Parquet file or folder as a stream; without a limit all that is there makes one batch.

    The path is given as a pattern, which the source accepts for a single file as well.
    """
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")
