"""Comparing source and target, and summing up runs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from tablesync.config import TOO_LONG_MESSAGE
from tablesync.operators.control import FAILED


def reconcile_counts(source: DataFrame, target: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows per group on both sides; a group one side lacks counts 0 there."""
    left = source.groupBy(*by).agg(F.count(F.lit(1)).alias("n_source"))
    right = target.groupBy(*by).agg(F.count(F.lit(1)).alias("n_target"))
    return compare_counts(left, right, by)


def compare_counts(source: DataFrame, target: DataFrame, by: Sequence[str]) -> DataFrame:
    """Counts ``n_source`` and ``n_target`` per group, side by side."""
    by = list(by)
    return source.join(target, by, "full_outer").select(
        *by,
        F.coalesce("n_source", F.lit(0)).alias("n_source"),
        F.coalesce("n_target", F.lit(0)).alias("n_target"),
    )


def reconcile_schema(source: DataFrame, target: DataFrame) -> DataFrame:
    """Columns that are missing, extra or of another type in the target.

    Both sides are column catalogs; names and types are compared lower-cased.
    Equal columns cancel out before anything is compared by name.
    """
    names = ["table_schema", "table_name", "column_name"]

    def lowered(columns: DataFrame, in_source: bool) -> DataFrame:
        return columns.select(
            *[F.lower(n).alias(n) for n in names],
            F.lower("data_type").alias("kind"),
            F.lit(in_source).alias("in_source"),
        )

    both = lowered(source, True).unionByName(lowered(target, False))
    one_sided = (
        both.groupBy(*names, "kind")
        .agg(F.max("in_source").alias("in_source"), F.min("in_source").alias("everywhere"))
        .where(F.col("in_source") == F.col("everywhere"))
    )
    left = F.max(F.when(F.col("in_source"), F.col("kind")))
    right = F.max(F.when(~F.col("in_source"), F.col("kind")))
    problem = (
        F.when(right.isNull(), "missing").when(left.isNull(), "extra").otherwise("type")
    )
    return one_sided.groupBy(*names).agg(
        left.alias("source_type"), right.alias("target_type"), problem.alias("diff")
    )


def reconcile_rows(
    source: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    fingerprint: bool = False,
) -> DataFrame:
    """Keys whose rows are missing, extra or changed in the target.

    Equal rows of the two sides cancel out in one grouped sum, which is taken
    in part before the shuffle; what is left over is classed by key. Repeated
    keys are compared as often as they occur and never paired with each other.
    ``fingerprint`` shuffles two 64-bit hashes in place of the other columns,
    for wide rows.
    """
    keys = list(keys)
    rest = [name for name in source.columns if name not in keys]
    if fingerprint:
        def shrink(rows: DataFrame) -> DataFrame:
            values = [F.col(f"`{name}`") for name in rest]
            # Null marks keep (null, x) and (x, null) apart.
            marks = [value.isNull() for value in values]
            one = F.xxhash64(*values, *marks)
            two = F.xxhash64(F.lit(1), *marks, *reversed(values))
            return rows.select(*keys, one.alias("__one"), two.alias("__two"))

        source, target = shrink(source), shrink(target)
    signed = source.withColumn("__sign", F.lit(1)).unionByName(
        target.select(source.columns).withColumn("__sign", F.lit(-1))
    )
    left_over = (
        signed.groupBy(*source.columns).agg(F.sum("__sign").alias("__net")).where("__net <> 0")
    )
    problem = (
        F.when(F.min("__net") > 0, "missing").when(F.max("__net") < 0, "extra").otherwise("changed")
    )
    return left_over.groupBy(*keys).agg(problem.alias("diff"))


def overlength(
    df: DataFrame, limits: Mapping[str, int], by: Sequence[str] = ()
) -> DataFrame:
    """Number and greatest length of strings over their limit, per column and group."""
    over = {name: F.length(F.col(f"`{name}`")) > limit for name, limit in limits.items()}
    found = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.count_if(too_long).alias("n_over"),
            F.max(F.when(too_long, F.length(F.col(f"`{name}`")).cast("long"))).alias("max_len"),
        )
        for name, too_long in over.items()
    ]
    counted = df.groupBy(*by).agg(F.array(*found).alias("__found"))
    return counted.select(*by, F.inline("__found")).where("n_over > 0")


def run_summary(run_log: DataFrame) -> DataFrame:
    """Runs, failures and too-long strings per tenant."""
    return run_log.groupBy("app_id").agg(
        F.count(F.lit(1)).alias("n_runs"),
        F.count_if(F.col("status") == FAILED).alias("n_failed"),
        F.count_if(F.col("message").contains(TOO_LONG_MESSAGE)).alias("n_too_long"),
    )
