"""A log of micro-batches on Parquet.

A batch is a folder of its own, named by its number. Writing a number again replaces that folder, so a batch that is
repeated after a failure leaves no second copy. Readers see all batches and reduce them by the rows' own order, so
results do not depend on where batches were cut.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH = "batch_id"
#: Number of the empty batch that makes a new log readable.
NONE = -1


class BatchLog:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str):
        self.spark, self.path = spark, path
        self.schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        spark.createDataFrame([], self.schema).write.mode("ignore").parquet(self._folder(NONE))

    def _folder(self, batch_id: int) -> str:
        return f"{self.path}/{BATCH}={batch_id}"

    def put(self, rows: DataFrame, batch_id: int) -> None:
        """Writes one batch, in place of an earlier one with this number."""
        rows.select(*self.schema.names).write.mode("overwrite").parquet(self._folder(batch_id))

    def read(self, with_batch: bool = False) -> DataFrame:
        stored = T.StructType([*self.schema.fields, T.StructField(BATCH, T.LongType())])
        rows = self.spark.read.schema(stored).option("basePath", self.path).parquet(self.path)
        return rows if with_batch else rows.drop(BATCH)

    def last_batch(self) -> int:
        """Number of the newest batch with rows, ``NONE`` if there is none."""
        last = self.read(True).agg(F.max(BATCH)).first()[0]
        return NONE if last is None else last

    def compacted(self, path: str, combine: Callable[[DataFrame], DataFrame]) -> BatchLog:
        """A new log at ``path`` whose first batch is ``combine`` of all rows; this one stays as it is."""
        new = BatchLog(self.spark, path, self.schema)
        new.put(combine(self.read()), 0)
        return new
