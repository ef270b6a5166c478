"""Comparing and reducing catalogs of tables and columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tablesync.config import (
    DATA_TYPES,
    NUMBER_TYPES,
    SIZE_COLUMNS,
    SNAPSHOT_TABLES,
    SYSTEM_SCHEMA,
    VIEW_TYPE,
)
from tablesync.functions.names import lower_columns, lower_values, qualified, same_name, stamped
from tablesync.operators.keys import KeyList
from tablesync.operators.widening import wider_type


def catalog_snapshot(
    tables: DataFrame,
    names: Sequence[str] = SNAPSHOT_TABLES,
    skip_schema: str = SYSTEM_SCHEMA,
    run_ts: datetime | Column | None = None,
) -> DataFrame:
    """Tracked base tables of the source, as rows of the staging catalog."""
    kept = lower_columns(tables).where(
        (F.lower("table_schema") != skip_schema.lower())
        & F.col("table_name").isin(*names)
        & (F.col("table_type") != VIEW_TYPE)
    )
    rows = kept.select(
        F.col("table_schema").alias("src_schema"),
        F.col("table_name").alias("src_table"),
        F.lit("").alias("tgt_schema"),
        F.lit("").alias("tgt_table"),
    )
    return stamped(rows, "synced_at", run_ts)


def missing_tables(source: DataFrame, target: DataFrame) -> DataFrame:
    """Distinct source tables that the target does not have, whatever the case.

    Both sides are reduced before they meet, so repeated names do not pile up
    in one task.
    """
    wanted = source.select(
        F.col("table_schema").alias("schema_name"), F.col("table_name").alias("table_name")
    ).distinct()
    present = target.select(
        same_name("table_schema").alias("has_schema"), same_name("table_name").alias("has_table")
    ).distinct()
    return wanted.join(
        present,
        (same_name("schema_name") == F.col("has_schema"))
        & (same_name("table_name") == F.col("has_table")),
        "left_anti",
    )


def column_catalog(
    columns: DataFrame,
    schemas: DataFrame,
    only: str | None = None,
    exclude: str | None = None,
) -> DataFrame:
    """Columns of all tables of the listed tenants, lower-cased, in one scan.

    Precision and scale of numbers are kept where the catalog has them.
    """
    named = lower_columns(columns)
    sizes = [name for name in SIZE_COLUMNS if name in named.columns]
    rows = named.select("table_schema", "table_name", "column_name", "data_type", *sizes)
    if only is not None:
        rows = rows.where(F.col("table_name") == only)
    if exclude is not None:
        rows = rows.where(F.col("table_name") != exclude)
    listed = lower_columns(schemas).select(same_name("table_schema").alias("tenant"))
    kept = KeyList.of(listed, ["tenant"]).keep(rows.withColumn("tenant", same_name("table_schema")))
    return lower_values(kept.drop("tenant")).distinct()


def declared_schema(columns: DataFrame, table_name: str) -> T.StructType:
    """The columns a table name has in a column catalog, for :func:`cdc.align`.

    A column that has different types in different tenants gets the narrowest that holds all of them
    exactly (see :func:`widening.wider`); one of unknown type becomes a string, which loses nothing. So
    does a number whose scale the catalog does not tell.
    """
    sizes = [
        F.col(name).cast("int") if name in columns.columns else F.lit(None).cast("int") for name in SIZE_COLUMNS
    ]
    # A few rows per column of one table: as many as it has types.
    found = (
        columns.where(same_name("table_name") == table_name.upper())
        .select(F.lower("column_name").alias("name"), F.lower("data_type").alias("kind"), *[
            size.alias(name) for size, name in zip(sizes, ("precision", "scale"))
        ])
        .distinct()
        .collect()
    )
    kinds: dict[str, list[T.DataType]] = {}
    for row in found:
        kinds.setdefault(row["name"], []).append(_declared_type(row["kind"], row["precision"], row["scale"]))
    return T.StructType([T.StructField(name, wider_type(kinds[name])) for name in sorted(kinds)])


def _declared_type(kind: str, precision: int | None, scale: int | None) -> T.DataType:
    if kind in NUMBER_TYPES and precision is not None and scale is not None and precision <= 38:
        return T.DecimalType(precision, scale)
    return T.StructType.fromDDL(f"x {DATA_TYPES.get(kind, 'string')}")["x"].dataType


def available_tables(columns: DataFrame) -> DataFrame:
    """Distinct ``schema.table`` names of a column catalog."""
    pairs = columns.select(
        F.lower("table_schema").alias("table_schema"), F.lower("table_name").alias("table_name")
    ).distinct()
    return pairs.select(qualified("table_schema", "table_name").alias("formatted_name"))


def group_tables(tables: DataFrame) -> DataFrame:
    """Number of tables and first table name per tenant."""
    return tables.groupBy(same_name("table_schema").alias("schema_name")).agg(
        F.count(F.lit(1)).alias("n_tables"),
        F.min(F.concat("table_schema", F.lit("."), "table_name")).alias("first_table"),
    )


def union_catalogs(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of several catalogs, columns matched by name."""
    return reduce(DataFrame.unionByName, others, first)


def split_available(
    rows: DataFrame, available: DataFrame, on: Iterable[str] = ("schema_name", "table_name")
) -> tuple[DataFrame, DataFrame]:
    """Rows of tables the target has, and the rest for quarantine.

    ``available`` holds the columns ``on``; names are compared without case.
    """
    on = list(on)
    marks = [f"__{name}" for name in on]
    names = available.select(*[same_name(name).alias(mark) for name, mark in zip(on, marks)])
    listed = KeyList.of(names, marks)
    marked = rows.withColumns({mark: same_name(name) for name, mark in zip(on, marks)})
    return listed.keep(marked).drop(*marks), listed.drop(marked).drop(*marks)
