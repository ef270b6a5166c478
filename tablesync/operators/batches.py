"""Landing files by tenant, and cutting tenants into batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tablesync.config import SCHEMA_POSITION, TABLE_POSITION, TENANT_BATCH, TENANT_INITIALS
from tablesync.functions.names import path_part, same_name
from tablesync.operators.keys import KeyList
from tablesync.session import reliable


def index_paths(
    files: DataFrame,
    schema_pos: int = SCHEMA_POSITION,
    table_pos: int = TABLE_POSITION,
    path: str = "path",
) -> DataFrame:
    """Add the tenant and the table named in each file's path."""
    return files.withColumns(
        {"schema_name": path_part(path, schema_pos), "table_name": path_part(path, table_pos)}
    )


def group_files(index: DataFrame, path: str = "path") -> DataFrame:
    """Number of files and first path per tenant and table, names lower-cased."""
    return index.groupBy(
        F.lower("schema_name").alias("schema_name"), F.lower("table_name").alias("table_name")
    ).agg(F.count(F.lit(1)).alias("n_files"), F.min(path).alias("first_path"))


def initial_filter(
    index: DataFrame, initials: Sequence[str] = TENANT_INITIALS, schema: str = "schema_name"
) -> DataFrame:
    """Rows of the tenants whose name starts with one of ``initials``."""
    first = F.upper(F.substring(schema, 1, 1))
    return index.where(first.isin(*[letter.upper() for letter in initials]))


def batch_members(
    index: DataFrame, tenants: DataFrame, tenant: str = "app_id", schema: str = "schema_name"
) -> DataFrame:
    """Files of the listed tenants, compared without case."""
    listed = KeyList.of(tenants.select(same_name(tenant).alias("__tenant")), ["__tenant"])
    return listed.keep(index.withColumn("__tenant", same_name(schema))).drop("__tenant")


def _placed(ordered: DataFrame, size: Column) -> DataFrame:
    """Sorted rows with ``__before``: the sizes of all rows before each, added up.

    Rows are added up within their partition of the sort; of the partitions, one row each passes
    through a single task.
    """
    row_bits = 33  # monotonically_increasing_id keeps the row in the low bits
    fixed = reliable(ordered.withColumns({"__id": F.monotonically_increasing_id(), "__size": size}))
    fixed = fixed.withColumn("__part", F.shiftrightunsigned("__id", row_bits))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("__size").over(before.partitionBy("__part").orderBy("__id")), F.lit(0))
    offsets = fixed.groupBy(F.col("__part").alias("__of")).agg(F.sum("__size").alias("__n"))
    offsets = offsets.select("__of", F.coalesce(F.sum("__n").over(before.orderBy("__of")), F.lit(0)).alias("__offset"))
    # One row per partition of the sort: at most spark.sql.shuffle.partitions.
    placed = fixed.withColumn("__inside", inside).join(F.broadcast(offsets), F.col("__part") == F.col("__of"))
    return placed.withColumn("__before", F.col("__inside") + F.col("__offset")).drop(
        "__id", "__size", "__part", "__of", "__inside", "__offset"
    )


def batch_by_weight(
    tenants: DataFrame, runs: int, weight: str = "weight", grain: int = 8, schema: str = "schema_name"
) -> DataFrame:
    """Cut tenants into ``runs`` runs of about the same weight (rows or bytes): ``schema_name, piece, n_pieces, weight, batch_id``.

    A tenant that is heavier than ``1 / grain`` of a run is dealt out in equal pieces (such as ranges of its keys, see
    ``find_splits``). Pieces are taken from the heaviest to the lightest, by name where they are the same, and a run
    ends when its share is full; so no run has more than ``1 + 1 / grain`` of the mean. Weights are whole
    numbers; rows of the same tenant are added up, and without any weight all are in the first run.
    """
    name = F.col(f"`{schema}`")
    summed = reliable(tenants.groupBy(name).agg(F.sum(weight).cast("long").alias("__weight")))
    total = summed.agg(F.sum("__weight")).first()[0] or 0
    most = max(1, -(-total // (runs * grain)))
    pieces = F.greatest(F.ceil(F.col("__weight") / F.lit(most)), F.lit(1)).cast("long")
    # Whole numbers that add up to the tenant's weight.
    ends = [F.expr("cast((cast(__weight as decimal(20,0)) * (piece + %d)) div n_pieces as long)" % k) for k in (0, 1)]
    cut = (
        summed.withColumn("n_pieces", pieces)
        .withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_pieces") - 1)))
        .select(name, "piece", "n_pieces", (ends[1] - ends[0]).alias("weight"))
    )
    placed = _placed(cut.orderBy(F.desc("weight"), name.asc_nulls_last(), "piece"), F.col("weight"))
    share = F.expr(f"cast((cast(__before as decimal(20,0)) * {runs}) div {max(total, 1)} as int)")
    return placed.select(name, "piece", "n_pieces", "weight", F.least(share, F.lit(runs - 1)).alias("batch_id"))


def batch_assign(
    tenants: DataFrame, size: int = TENANT_BATCH, schema: str = "schema_name"
) -> DataFrame:
    """Number the distinct tenants in name order and cut them into batches.

    The names are sorted across partitions; a name's place is its place within
    its partition plus the sizes of the partitions before it. Only those sizes,
    one row per partition, pass through a single task.
    """
    name = F.col(f"`{schema}`")
    placed = _placed(tenants.select(schema).distinct().orderBy(name.asc_nulls_last()), F.lit(1))
    return placed.select(name, F.floor(F.col("__before") / F.lit(size)).cast("int").alias("batch_id"))
