"""Reading what has been added to tables since they were last read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablesync.session import reliable, staged
from tablesync.sinks.appended import AppendedTable
from tablesync.sinks.bookmark import Bookmark
from tablesync.sinks.target import TargetTable
from tablesync.sources.growing import TENANT, Growing, GrowingTables, bounds_of


def pull_increment(
    spark: SparkSession,
    source: GrowingTables,
    name: str,
    tenants: DataFrame,
    target: TargetTable,
    bookmark: Bookmark,
    growing: Growing,
) -> DataFrame:
    """Read the rows of ``name`` that are new since the bookmark, and merge them; return the bounds of the read.

    The bookmark moves on only when the rows are in the target; if the job
    breaks off before, the same rows are read and merged again, which alters
    nothing. Rows that the overlap brings again are recognised by key. Rows older
    than the overlap, and rows deleted at the source, are only found by a full load
    (``Bookmark.reset``).
    """
    if isinstance(target, AppendedTable) or not target.keys:
        raise ValueError("rows that are read twice are recognised by key")
    marks = bookmark.marks(spark, name)
    bounds = reliable(bounds_of(tenants, marks, source.highs(name, tenants, growing)))
    with staged(source.between(name, bounds, growing), "increment") as rows:
        target.merge(rows)
    bookmark.advance(name, bounds.select(TENANT, F.col("high").alias("mark")))
    return bounds
