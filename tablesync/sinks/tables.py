"""Writing whole tables: refresh, append, control table, schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablesync.session import staged
from tablesync.sources.database import Connection


def refresh_table(df: DataFrame, target: str, conn: Connection | None = None) -> None:
    """Replace the rows of a table, and create it if it does not exist.

    In a database the table itself stays: it is truncated, not dropped.
    """
    if conn is None:
        df.write.mode("overwrite").saveAsTable(target)
    else:
        conn.writer(df, "overwrite").option("truncate", "true").option("dbtable", target).save()


def write_table(
    df: DataFrame, target: str, mode: str = "append", conn: Connection | None = None
) -> None:
    """Write rows to a table of the catalog, or of a database."""
    if conn is None:
        df.write.mode(mode).saveAsTable(target)
    else:
        conn.writer(df, mode).option("dbtable", target).save()


def replace_folder(df: DataFrame, path: str) -> None:
    """Overwrite a parquet folder with rows that may be read from it.

    The rows are complete in the shared folder before the old files go, and
    stay there if the write fails.
    """
    with staged(df, "replace", keep_on_error=True) as rows:
        rows.write.mode("overwrite").parquet(path)


def ensure_schema(spark: SparkSession, name: str) -> None:
    """Create a schema if it does not exist."""
    quoted = "`" + name.replace("`", "``") + "`"
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted}")
