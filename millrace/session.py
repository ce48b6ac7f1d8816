"""Session defaults and the shared folder for written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A split skewed join may cost one more exchange; one task holding a third of the rows costs more.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows that lie together by one of several join keys are not dealt out again by all of them.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # A task that writes a few partitions keeps their files open and need not sort its rows; with more of them it sorts.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    # Written tables hold digests, of which this codec keeps half; the default one keeps all.
    "spark.sql.parquet.compression.codec": "zstd",
}

_own_dirs: dict[str, str] = {}


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


SPLIT_BYTES = 16 << 20
#: What one task reads at most of a file, and about what it reads of a shuffle, where partitions are put together.
_BOUNDED = {"spark.sql.files.maxPartitionBytes": "128m", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m"}


def apply_defaults(spark: SparkSession) -> None:
    """Sets the run-time options on a session somebody else created."""
    for key, value in _DEFAULTS.items():
        spark.conf.set(key, value)
    # Columns of keys and dates are tens of times as long in memory as in a file. What a task sorts before it sends rows must
    # fit into its memory at every size of the input; a smaller setting of the session stays.
    for key, default in _BOUNDED.items():
        now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key, default))
        if now > SPLIT_BYTES:
            spark.conf.set(key, str(SPLIT_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can read and that outlives each of them.

    A cluster names it in ``spark.checkpoint.dir``. A temporary folder is made only
    in local mode, where driver and executors are one process.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = tempfile.mkdtemp(prefix="millrace-")
    return _own_dirs[app]


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared folder: computed once, and safe from lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{label}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
