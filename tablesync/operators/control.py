"""The load-control table: which tenants exist, and which need a full load."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tablesync.config import FULL_LOAD_TABLES
from tablesync.functions.names import same_name, timestamp_text

FAILED = "failed"
OK = "ok"


def insert_if_absent(control: DataFrame, app_ids: DataFrame) -> DataFrame:
    """The control table with a row for every tenant of ``app_ids``, however often or in what case it is spelled."""
    known = control.select(same_name("app_id").alias("__known"))
    absent = (
        app_ids.groupBy(same_name("app_id").alias("__same"))
        .agg(F.min("app_id").alias("app_id"))
        .drop("__same")
        .join(known, same_name("app_id") == F.col("__known"), "left_anti")
    )
    return control.unionByName(absent, allowMissingColumns=True)


def full_load_plan(
    control: DataFrame, tables: Sequence[str] | Column = FULL_LOAD_TABLES
) -> DataFrame:
    """Every table name for every flagged tenant.

    ``tables`` is a list of names, or an array column (such as a scalar
    subquery); it is unfolded next to each tenant, without a join.
    """
    if not isinstance(tables, Column):
        tables = F.array(*[F.lit(name) for name in dict.fromkeys(t.lower() for t in tables)])
    tenants = control.where("flag").select(F.lower("app_id").alias("app_id")).distinct()
    return tenants.select("app_id", F.explode(tables).alias("table_name"))


def clear_flags(
    control: DataFrame,
    run_log: DataFrame,
    run_ts: datetime | Column | None = None,
    only_run: bool = False,
) -> DataFrame:
    """The control table with the flag off for tenants without a failure.

    With ``only_run`` a tenant that the run log does not mention keeps its
    flag. If the table has ``fullload_timestamp``, it is set to ``run_ts``.
    """
    failures = run_log.groupBy(same_name("app_id").alias("__app")).agg(
        F.count_if(F.col("status") == FAILED).alias("__failed")
    )
    joined = control.join(failures, same_name("app_id") == F.col("__app"), "left")
    failed = F.col("__failed") if only_run else F.coalesce("__failed", F.lit(0))
    done = F.coalesce(F.col("flag") & (failed == 0), F.lit(False))
    changed = {"flag": F.when(done, F.lit(False)).otherwise(F.col("flag"))}
    if "fullload_timestamp" in control.columns and run_ts is not None:
        moment = run_ts if isinstance(run_ts, Column) else F.lit(run_ts)
        if control.schema["fullload_timestamp"].dataType.simpleString() == "string":
            moment = timestamp_text(moment)
        changed["fullload_timestamp"] = F.when(done, moment).otherwise(
            F.col("fullload_timestamp")
        )
    return joined.select([changed.get(n, F.col(f"`{n}`")).alias(n) for n in control.columns])
