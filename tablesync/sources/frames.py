"""SQL over named frames, and frames with a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T


def sql_over(spark: SparkSession, query: str, **frames: DataFrame) -> DataFrame:
    """Run a query whose ``{name}`` places stand for the given frames."""
    return spark.sql(query, **frames)


def empty_frame(spark: SparkSession, schema: str | T.StructType) -> DataFrame:
    """A frame without rows."""
    return spark.createDataFrame([], schema)


def column_rows(spark: SparkSession, schema_name: str, table_name: str, schema: T.StructType):
    """The column catalog of a frame's schema: one row per column."""
    rows = [(schema_name, table_name, f.name, f.dataType.simpleString()) for f in schema.fields]
    return spark.createDataFrame(
        rows, "table_schema string, table_name string, column_name string, data_type string"
    )
