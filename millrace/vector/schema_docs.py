"""One text line per table from its column metadata, as input for an embedding model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COLUMNS_SCHEMA = "table_schema string, table_name string, ordinal int, column_name string, data_type string"


def schema_documents(columns: DataFrame) -> DataFrame:
    """``schema.table: column (type), ...`` in column order; a table has a bounded number of columns."""
    entry = F.struct("ordinal", F.concat("column_name", F.lit(" ("), F.col("data_type"), F.lit(")")).alias("text"))
    listed = columns.groupBy("table_schema", "table_name").agg(F.sort_array(F.collect_list(entry)).alias("_c"))
    return listed.select("table_schema", "table_name", F.concat(
        "table_schema", F.lit("."), "table_name", F.lit(": "), F.array_join("_c.text", ", ")).alias("document"))
