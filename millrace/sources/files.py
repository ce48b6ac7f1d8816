"""Files in a landing zone: discovery against a manifest, reading by format, quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BAD_LINE = "_bad_line"
SOURCE = "source_file"
MANIFEST_SCHEMA = ("file_path string, size_bytes bigint, status string, rows_loaded bigint, error string, "
                   "discovered_at timestamp, loaded_at timestamp")


def _sourced(df: DataFrame) -> DataFrame:
    return df.select("*", F.col("_metadata.file_path").alias(SOURCE))


def read_jsonl(spark: SparkSession, paths: str | list[str], schema: str) -> DataFrame:
    """Blank lines vanish; a line that does not parse keeps its text in ``_bad_line``."""
    lines = _sourced(spark.read.text(paths)).filter(F.trim("value") != "")
    row = F.from_json("value", f"{schema}, {BAD_LINE} string", {"columnNameOfCorruptRecord": BAD_LINE})
    return lines.select(SOURCE, F.explode(F.array(row)).alias("_row")).select("_row.*", SOURCE)


def read_csv(spark: SparkSession, paths: str | list[str], schema: str | None = None) -> DataFrame:
    """Header line, every column text."""
    return _sourced(spark.read.option("header", True).csv(paths))


def read_parquet(spark: SparkSession, paths: str | list[str], schema: str | None = None) -> DataFrame:
    return _sourced(spark.read.parquet(*([paths] if isinstance(paths, str) else paths)))


READERS = {"jsonl": read_jsonl, "csv": read_csv, "parquet": read_parquet}


def reader_for(path: str):
    """Chosen by extension: what a feed is declared to be and what it writes can differ."""
    extension = path.rsplit(".", 1)[-1].lower()
    if extension not in READERS:
        raise ValueError(f"unsupported file format: {path}")
    return READERS[extension]


def split_bad_lines(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.filter(F.col(BAD_LINE).isNull()).drop(BAD_LINE), df.filter(F.col(BAD_LINE).isNotNull())


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Path and size of every file below a folder; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select(
        F.col("path").alias("file_path"), F.col("length").alias("size_bytes"),
        F.col("modificationTime").alias("modified_at"))


def discover(listing: DataFrame, manifest: DataFrame, max_files: int | None = None,
             retry_quarantined: bool = False) -> DataFrame:
    """Files still to load, oldest path first; ``max_files`` bounds one run.

    Only finished files are skipped: one that an earlier run found but had no room for
    comes back, a quarantined one on request.
    """
    finished = ["loaded"] if retry_quarantined else ["loaded", "quarantined"]
    done = manifest.filter(F.col("status").isin(finished)).select("file_path")
    waiting = listing.join(done, "file_path", "left_anti").orderBy("file_path")
    return waiting if max_files is None else waiting.limit(max_files)


def with_row_identity(df: DataFrame) -> DataFrame:
    """Content hash of each row; with the source path it is an id that no read order changes."""
    content = [c for c in df.columns if c not in (BAD_LINE, SOURCE)]
    return df.withColumn("line_hash", F.sha2(F.to_json(F.struct(*content)), 256))


def write_dated(df: DataFrame, path: str, date_column: str, file_format: str = "parquet") -> None:
    """Appends below ``date_column=...`` folders. JSON lines, CSV with header, or Parquet."""
    writer = df.write.mode("append").partitionBy(date_column)
    if file_format == "csv":
        writer = writer.option("header", True)
    writer.format({"jsonl": "json"}.get(file_format, file_format)).save(path)


def write_run(df: DataFrame, path: str) -> None:
    """Replaces only the ``run_id=...`` folders present in ``df``."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)
