"""Tables of which a load replaces only the partitions that it touches.

A table is plain Parquet below a path, partitioned by one column: a day, or a bucket of keys. Spark's dynamic partition
overwrite does the replacing; partitions that are left without rows are removed. New rows are written aside first, so a
frame may read the partitions that it is going to replace.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written


def bucket_of(key: str | Column, buckets: int) -> Column:
    """Bucket of a key; all tables with the same number of buckets agree."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")


def values_of(rows: DataFrame, column: str) -> list:
    """The distinct partition values of ``rows``: days of a calendar or buckets, never keys."""
    return sorted(r[0] for r in rows.select(column).distinct().collect())


class PartitionedTable:
    def __init__(self, spark: SparkSession, path: str, by: str, schema: T.StructType):
        """``schema`` includes the partition column ``by``, which must have a value in every row."""
        self.spark, self.path, self.by = spark, path, by
        self.schema = T.StructType([*[f for f in schema.fields if f.name != by], schema[by]])
        spark.createDataFrame([], self.schema).write.mode("ignore").partitionBy(by).parquet(path)

    def read(self, values: Iterable | None = None) -> DataFrame:
        """All rows, or those of some partitions; files of other partitions are not opened."""
        rows = self.spark.read.schema(self.schema).parquet(self.path)
        return rows if values is None else rows.filter(F.col(self.by).isin(list(values)))

    def _shaped(self, rows: DataFrame) -> DataFrame:
        return rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields])

    def append(self, rows: DataFrame) -> None:
        self._shaped(rows).write.mode("append").partitionBy(self.by).parquet(self.path)

    def replace(self, values: Iterable, rows: DataFrame) -> None:
        """Makes ``rows`` the content of the partitions ``values``; rows of other partitions must not be among them."""
        fresh = written(self._shaped(rows), "partitions")
        self._overwrite(fresh)
        self._remove(set(values) - set(values_of(fresh, self.by)))

    def replace_all(self, rows: DataFrame) -> None:
        """The same for ``rows`` that do not come from this table and have some for each partition that is to be replaced."""
        self._overwrite(self._shaped(rows))

    def _overwrite(self, rows: DataFrame) -> None:
        # Dealt out by partition, a large one to several tasks, so that none sorts and writes a whole partition.
        rows.hint("rebalance", self.by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(self.by).parquet(self.path)

    def _remove(self, values: Iterable) -> None:
        path_of, conf = self.spark._jvm.org.apache.hadoop.fs.Path, self.spark._jsc.hadoopConfiguration()
        for value in values:
            folder = path_of(f"{self.path}/{self.by}={value}")
            folder.getFileSystem(conf).delete(folder, True)
