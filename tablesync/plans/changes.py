"""Applying landing files in one batch: the job without a stream."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from contextlib import nullcontext
from dataclasses import dataclass, field
from datetime import datetime, timezone
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, types as T

from tablesync.config import MAX_RUN_FILES, SCHEMA_POSITION, TABLE_POSITION
from tablesync.operators.catalog import split_available
from tablesync.operators.cdc import DELETE_CODE
from tablesync.operators.control import FAILED, OK, insert_if_absent
from tablesync.plans.loads import changed_tenants
from tablesync.session import reliable, staged
from tablesync.sinks.appended import AppendedTable
from tablesync.sinks.ledger import FileLedger, first_files
from tablesync.sinks.tables import replace_folder
from tablesync.sinks.target import TargetTable
from tablesync.sources.landing import listed_files, read_changes, read_files

APPLIED = "run string, table_name string, n_files long, status string, message string"


class LandingFailed(Exception):
    """Files of some tables could not be applied; ``log`` says which. The next run takes them up again."""

    def __init__(self, message: str, log: DataFrame):
        super().__init__(message)
        self.log = log


@dataclass(frozen=True)
class Route:
    """Where the files of one table name go, and how they are read.

    A target with keys has its rows merged; one without has them added.
    """

    target: TargetTable | AppendedTable
    schema: str | T.StructType
    op_col: str | None = None
    delete_code: str = DELETE_CODE
    fmt: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)

    def apply(self, rows: DataFrame, run: str) -> None:
        if isinstance(self.target, AppendedTable):
            self.target.append(rows, run)
        else:
            self.target.merge(rows, self.op_col, self.delete_code)


def apply_new(
    spark: SparkSession,
    root: str,
    routes: Mapping[str, Route],
    ledger: FileLedger,
    available: DataFrame | None = None,
    quarantine: str | None = None,
    archive: str | None = None,
    max_files: int = MAX_RUN_FILES,
    schema_pos: int = SCHEMA_POSITION,
    table_pos: int = TABLE_POSITION,
) -> DataFrame:
    """Apply all landing files that are not applied yet, of every table name that has a route.

    The landing folder is listed once; nothing of files that are applied is
    read. Files are taken oldest first, at most ``max_files`` a run; all files of a
    table name in a run are one job, whatever their tenants. What an earlier call
    left unfinished is done first. With ``available`` (tenant and table names),
    changes of unknown tables go below ``quarantine``, by table and run. With
    ``archive``, applied files are moved there and forgotten.

    Returns the log: what each run did with each table. A table that fails does not keep the
    others from being applied; :class:`LandingFailed` is raised at the end.
    """
    if (available is None) != (quarantine is None):
        raise ValueError("available and quarantine go together")
    routes = {name.lower(): route for name, route in routes.items()}
    files = reliable(listed_files(spark, root, schema_pos, table_pos))
    log: list[tuple] = []

    def one_run(run: str) -> None:
        paths: dict[str, list[str]] = {}
        closed = {r[0] for r in ledger.closed(spark).where(f"run = '{run}'").select("table_name").distinct().collect()}
        for row in ledger.planned(spark, run).select("table_name", "path").collect():  # at most max_files
            paths.setdefault(row["table_name"], []).append(row["path"])
        failed = False
        for name in sorted(set(paths) - closed):
            status, message = OK, None
            try:
                if name not in routes:
                    raise KeyError(f"no route for the files of {name}")
                route = routes[name]
                rows = read_files(spark, paths[name], root, route.schema, route.fmt, schema_pos, table_pos, route.options)
                with staged(rows, "landing") if available is not None else nullcontext(rows) as found:
                    if available is not None:
                        found, unknown = split_available(found, available)
                        unknown.write.mode("overwrite").parquet(f"{quarantine}/table={quote(name, safe='')}/run={run}")
                    route.apply(found, run)
                ledger.close(spark, run, name)
            except Exception as error:  # noqa: BLE001 - whatever went wrong goes to the log
                failed, status, message = True, FAILED, str(error)
            log.append((run, name, len(paths[name]), status, message))
        if not failed:
            ledger.finish(spark, run)

    for run in ledger.open_runs(spark):
        one_run(run)
    while True:
        next_files = first_files(ledger.fresh(files), max_files, routes)
        run = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
        ledger.plan(next_files, run)
        if ledger.planned(spark, run).isEmpty():
            ledger.finish(spark, run)
            break
        one_run(run)
    if archive is not None:
        ledger.archive(files, root, archive)
        ledger.compact(listed_files(spark, root, schema_pos, table_pos))
    done = spark.createDataFrame(log, APPLIED)
    failures = [f"{name} in {run}" for run, name, _, status, _ in log if status == FAILED]
    if failures:
        raise LandingFailed(f"not applied: {', '.join(failures)}", done)
    return done


def apply_landing(
    spark: SparkSession,
    root: str,
    schema: str | T.StructType,
    table: str,
    target: TargetTable,
    available: DataFrame,
    quarantine: str,
    op_col: str | None = None,
    delete_code: str = DELETE_CODE,
    fmt: str = "parquet",
) -> None:
    """Merge all change files of one table name; changes of unknown tables are set aside.

    Each run has a folder of its own below ``quarantine``, by table and run.
    The landing files are read once, into a staged table.
    """
    with staged(read_changes(spark, root, schema, fmt, table), "landing") as rows:
        known, unknown = split_available(rows, available)
        unknown.write.parquet(f"{quarantine}/table={quote(table)}/run={uuid.uuid4().hex}")
        target.merge(known, op_col, delete_code)


def register_tenants(index: DataFrame, control: DataFrame, control_path: str) -> None:
    """Give every tenant of the landing files a row in the control table."""
    replace_folder(insert_if_absent(control, changed_tenants(index)), control_path)
