"""Corpus pipeline: language, repeated line runs, near copies, benchmark items, then tokens.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before kept. A stage's result is written as
Parquet in the folder that all executors share and read again for the next.
"""

from __future__ import annotations

import gc
from collections.abc import Callable

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe_chunks, decontamination, language_id, line_dedup, shingle_dedup
from millrace.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def settle(spark: SparkSession) -> None:
    """Frees what the stages before have left on the driver: Python and Arrow memory, plans, and with them broadcasts and shuffles."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    spark.sparkContext._jvm.System.gc()


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages of the labelled documents; texts without a letter go."""
    settle(spark)
    return language_id.keep_identified(docs, language_id.learn(docs.select("lang", "text")))


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of line runs; a document goes if nothing is left of it."""
    settle(spark)
    return line_dedup.replace_texts(docs).withColumn("n_chars", F.length("text").cast("bigint"))


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id: SimHash fingerprints joined by a trie and
    min-hash bands find candidates, five-word shingle sets at Jaccard 0.8 decide."""
    settle(spark)
    return shingle_dedup.keep_one(docs)


def remove_benchmark_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    settle(spark)
    return decontamination.drop_contaminated(docs, decontamination.build_indexes(table(spark, sf_dir, "benchmark")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of each document, with digests of the tokens and of the text that they decode to."""
    settle(spark)
    encoded = bpe_chunks.encode_decode(docs, VOCABULARY)
    return encoded.select("tokens", *bpe_chunks.digest_columns("doc_id"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language), ("line_dedup", remove_repeated_lines), ("simhash_dedup", remove_near_copies),
    ("decontamination", remove_benchmark_items), ("bpe", encode)]

#: No SQL: code lengths, fingerprints and tokens are beyond it; tests hold the result against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    name, stage = STAGES[-1]
    return stored(stage(spark, docs, sf_dir), f"stage-{name}")
