"""Kafka sources. Needs the Kafka connector package on the class path."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession


def starting_offsets(topic: str, last: dict[int, int], partitions: int) -> str:
    """Start after the stored offset of each partition, at the beginning where none is stored."""
    return json.dumps({topic: {str(p): last[p] + 1 if p in last else -2 for p in range(partitions)}})


def read_batch(spark: SparkSession, servers: str, topic: str, last: dict[int, int], partitions: int) -> DataFrame:
    """Everything between the stored offsets and now."""
    return spark.read.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option(
        "startingOffsets", starting_offsets(topic, last, partitions)).option("endingOffsets", "latest").load()


def read_stream(spark: SparkSession, servers: str, *, topics: str | None = None, pattern: str | None = None,
                start: str = "earliest", per_trigger: int | None = None, fail_on_data_loss: bool = False) -> DataFrame:
    """Topics by comma list or by regular expression."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option(
        "startingOffsets", start).option("failOnDataLoss", str(fail_on_data_loss).lower())
    reader = reader.option("subscribePattern", pattern) if pattern else reader.option("subscribe", topics)
    if per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", per_trigger)
    return reader.load()
