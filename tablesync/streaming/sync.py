"""Changes as a stream of landing files, each applied once."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from tablesync.config import SCHEMA_POSITION, TABLE_POSITION
from tablesync.operators.catalog import split_available
from tablesync.operators.cdc import DELETE_CODE
from tablesync.session import adaptive, staged
from tablesync.sinks.target import TargetTable
from tablesync.sources.landing import table_glob, with_place


def stream_changes(
    spark: SparkSession,
    root: str,
    schema: str | T.StructType,
    table: str,
    fmt: str = "parquet",
    max_files: int | None = None,
    archive: str | None = None,
    schema_pos: int = SCHEMA_POSITION,
    table_pos: int = TABLE_POSITION,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """New landing files of one table name, with tenant and table from their path."""
    reader = spark.readStream.format(fmt).schema(schema).options(**(options or {}))
    reader = reader.option("recursiveFileLookup", "true")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    rows = reader.load(table_glob(root, table, schema_pos, table_pos))
    return with_place(rows, root, schema_pos, table_pos)


def sync_stream(
    spark: SparkSession,
    root: str,
    schema: str | T.StructType,
    table: str,
    target: TargetTable,
    checkpoint: str,
    op_col: str | None = None,
    delete_code: str = DELETE_CODE,
    fmt: str = "parquet",
    max_files: int | None = 1000,
    archive: str | None = None,
    available: DataFrame | None = None,
    quarantine: str | None = None,
    schema_pos: int = SCHEMA_POSITION,
    table_pos: int = TABLE_POSITION,
    options: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Apply all landing files that are not applied yet, then stop.

    The checkpoint remembers which files are done. A batch that is repeated
    after a failure alters nothing. With ``available`` (tenant and table
    names), changes of unknown tables go below the folder ``quarantine``, by
    table, stream (told by its checkpoint) and batch; ``options`` go to the file reader. With ``archive``, the files of a batch move there when a later batch is planned.
    """
    if (available is None) != (quarantine is None):
        raise ValueError("available and quarantine go together")
    changes = stream_changes(
        spark, root, schema, table, fmt, max_files, archive, schema_pos, table_pos, options
    )

    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]
    place = f"{quarantine}/table={quote(table)}/stream={stream}"

    def apply(batch: DataFrame, batch_id: int) -> None:
        with adaptive(batch.sparkSession):
            if available is None:
                target.merge(batch, op_col, delete_code)
                return
            with staged(batch, "batch") as read:
                rows, unknown = split_available(read, available)
                # Overwritten only when the same batch of the same stream is repeated.
                unknown.write.mode("overwrite").parquet(f"{place}/batch={batch_id}")
                target.merge(rows, op_col, delete_code)

    return (
        changes.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def sync_tables(
    spark: SparkSession,
    root: str,
    tables: Mapping[str, tuple[str | T.StructType, TargetTable]],
    checkpoint: str,
    **options,
) -> None:
    """Run :func:`sync_stream` for several table names, given schema and target of each.

    The streams run side by side, each with its own checkpoint. All of them
    end before the first failure is raised.
    """
    running = []
    for name, (schema, target) in tables.items():
        query = sync_stream(spark, root, schema, name, target, f"{checkpoint}/{name}", **options)
        running.append(query)
    failures = []
    for query in running:
        try:
            query.awaitTermination()
        except Exception as error:  # noqa: BLE001 - raised below, after the others
            failures.append(error)
    if failures:
        raise failures[0]
