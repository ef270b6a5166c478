"""Refreshing the staging catalog from the source's table catalog."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import SparkSession

from tablesync.config import SNAPSHOT_TABLES
from tablesync.operators.catalog import catalog_snapshot
from tablesync.sinks.tables import refresh_table
from tablesync.sources.database import Connection, read_table


def snapshot_catalog(
    spark: SparkSession,
    source: Connection,
    target: str,
    target_conn: Connection | None = None,
    names: Sequence[str] = SNAPSHOT_TABLES,
    catalog: str = "INFORMATION_SCHEMA.TABLES",
    run_ts: datetime | None = None,
) -> None:
    """Read the source's table catalog and replace the staging table by it."""
    rows = catalog_snapshot(read_table(spark, source, catalog), names, run_ts=run_ts)
    refresh_table(rows, target, target_conn)
