"""A replicated table: parquet, partitioned by tenant and key bucket."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tablesync.config import BROADCAST_BYTES, FILE_BYTES, MAX_FOLDER_LIST, MAX_PARTITION_LIST
from tablesync.operators.cdc import (
    DELETE_CODE,
    DELETED,
    align,
    choose_newer,
    latest_change,
    same_key,
    tie_columns,
    with_deleted,
)
from tablesync.operators.keys import KeyList, row_bytes
from tablesync.session import folder_exists, folder_files, partition_folder, staged, wide_shuffle
from tablesync.sinks.layout import CLEAN, COPY, Layout, bucket_number, parted_bucket, stored_layout

BUCKET = "key_bucket"


@dataclass(frozen=True)
class Touched:
    """What a set of changes amounts to; ``spots`` is None if there are too many."""

    partitions: int
    bytes: int
    without_key: int
    spots: list[str] | None


@dataclass(frozen=True)
class TargetTable:
    """One table name across all tenants.

    A tenant's rows lie in ``buckets`` partitions by a hash of the merge keys,
    so a few changes do not rewrite the whole tenant; ``tenant_buckets`` gives
    large tenants more. Both are what a new table starts with: its layout is
    stored with it, and :meth:`split` adds buckets to a tenant that has grown.
    Stored besides the data are the order columns and the
    flag ``deleted``: deleted rows stay as tombstones, so an older change that
    arrives late cannot bring them back. Tenant names are stored in lower case,
    since the same tenant is spelled differently in catalogs and file paths.
    """

    path: str
    keys: tuple[str, ...]
    order: tuple[str, ...]
    tenant: str = "schema_name"
    buckets: int = 1
    tenant_buckets: Mapping[str, int] = field(default_factory=dict)
    # Data and order columns with the tenant; found in the files if left out.
    schema: str | None = None

    @property
    def row_key(self) -> list[str]:
        return [self.tenant, *self.keys]

    @property
    def partitions(self) -> list[str]:
        return [self.tenant, BUCKET]

    def layout(self, spark: SparkSession) -> Layout:
        """The stored bucket counts, or those a new table starts with."""
        own = {name.lower(): count for name, count in self.tenant_buckets.items()}
        return stored_layout(spark, self.path) or Layout(self.buckets, own)

    def _settled_layout(self, spark: SparkSession) -> Layout:
        """The layout, after what a broken :meth:`split` has left is done."""
        layout = self.layout(spark)
        for tenant in sorted(layout.moving):
            layout = self._finish_split(spark, layout, tenant)
        return layout

    def _own_names(self, df: DataFrame) -> DataFrame:
        """Tenant names in lower case; an empty one would be stored as null, and is refused."""
        empty = F.raise_error(F.lit(f"a row with an empty {self.tenant}"))
        return df.withColumn(
            self.tenant, F.when(F.col(self.tenant) == "", empty).otherwise(F.lower(self.tenant))
        )

    def _hash(self) -> Column:
        return F.xxhash64(*[F.col(f"`{k}`") for k in self.keys])

    def with_bucket(self, df: DataFrame, layout: Layout) -> DataFrame:
        return df.withColumn(BUCKET, layout.number(self.tenant, self._hash()))

    def read(self, spark: SparkSession) -> DataFrame:
        """All stored rows, tombstones included."""
        schema = self.stored_schema(spark)
        if not folder_exists(spark, self.path):
            return spark.createDataFrame([], schema)
        rows, layout = spark.read.schema(schema).parquet(self.path), self.layout(spark)
        if layout.moving:
            settled = ~F.col(self.tenant).isin(sorted(layout.moving))
            rows = rows.where(settled | (F.col(BUCKET) == layout.number(self.tenant, self._hash())))
        return rows

    def split(self, spark: SparkSession, tenant: str, times: int = 1) -> None:
        """Add buckets to a tenant that has grown; each step rewrites one of its buckets.

        Readers see every row once at any time. If the job ends in between, the
        next one that writes the table goes on where it ended.
        """
        name = tenant.lower()
        layout = self._settled_layout(spark)
        for _ in range(times):
            layout = layout.changed(name, layout.of(name), COPY).store(spark, self.path)
            layout = self._finish_split(spark, layout, name)

    def _finish_split(self, spark: SparkSession, layout: Layout, name: str) -> Layout:
        """Part a bucket: rows that move are copied, then the layout is changed, then they go from where they were."""
        schema = self.stored_schema(spark)

        def write(source: int, number: int, count: int) -> None:
            """Rows of the bucket ``source`` that belong to ``number`` among ``count``, as that bucket."""
            mine = (F.col(self.tenant) == name) & (F.col(BUCKET) == source)
            rows = spark.read.schema(schema).parquet(self.path).where(mine).withColumn(BUCKET, bucket_number(self._hash(), count))
            # A hidden row has the partition written even if nothing is in it.
            hidden = spark.range(1).select(
                F.lit(name).alias(self.tenant), F.lit(number).alias(BUCKET), F.lit(True).alias(DELETED)
            )
            with staged(rows.where(F.col(BUCKET) == number).unionByName(hidden, allowMissingColumns=True), "split") as kept:
                self._write(kept)

        if layout.moving[name] == COPY:
            added = layout.of(name)
            write(parted_bucket(added), added, added + 1)
            layout = layout.changed(name, added + 1, CLEAN).store(spark, self.path)
        count = layout.of(name)
        write(parted_bucket(count - 1), parted_bucket(count - 1), count)
        return layout.changed(name, count, None).store(spark, self.path)

    def tenants(self, spark: SparkSession) -> DataFrame:
        """The distinct tenants that have the table, with or without rows."""
        return self._files(spark).select(self.tenant).distinct()

    def _files(self, spark: SparkSession) -> DataFrame:
        """Sizes and partitions of the stored files; contents are not read."""
        listing = (
            "path string, modificationTime timestamp, length long, content binary, "
            f"`{self.tenant}` string, {BUCKET} int"
        )
        if not folder_exists(spark, self.path):
            return spark.createDataFrame([], listing)
        return spark.read.format("binaryFile").schema(listing).load(self.path)

    def of_tenants(self, spark: SparkSession, tenants: DataFrame) -> DataFrame:
        """The stored rows of the given tenants, read from their folders only."""
        tenants = self._own_names(tenants.select(self.tenant)).distinct()
        names = tenants.limit(MAX_PARTITION_LIST + 1).collect()
        few = len(names) <= MAX_PARTITION_LIST
        spots = [row[0] for row in names] if few else None
        return self._in_partitions(self.read(spark), tenants, [self.tenant], spots)

    def stored_schema(self, spark: SparkSession) -> T.StructType:
        if self.schema is None:
            found = spark.read.parquet(self.path).schema
        else:
            found = T.StructType.fromDDL(self.schema)
        # A tenant called "007" must not come back as the number 7.
        kept = [f for f in found.fields if f.name not in (self.tenant, BUCKET, DELETED)]
        return T.StructType(
            [
                *[T.StructField(f.name, f.dataType) for f in kept],
                T.StructField(DELETED, T.BooleanType()),
                T.StructField(self.tenant, T.StringType()),
                T.StructField(BUCKET, T.IntegerType()),
            ]
        )

    def current(self, spark: SparkSession) -> DataFrame:
        """The rows that are not deleted, as a reader wants them."""
        return self.read(spark).where(~F.col(DELETED)).drop(DELETED, BUCKET)

    def _write(self, df: DataFrame) -> None:
        (
            df.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*self.partitions)
            .parquet(self.path)
        )

    def load(
        self,
        rows: DataFrame,
        tenants: DataFrame,
        by_tenant: bool = False,
    ) -> None:
        """Replace everything the given tenants have by ``rows``, which are all theirs.

        Loaded rows are older than any change, unless they carry order columns.
        Every partition of a loaded tenant gets one hidden row, so that a
        partition or tenant without rows in ``rows`` is emptied as well, in the
        same job. ``by_tenant`` says that the partitions of ``rows`` hold one tenant each,
        which saves the shuffle that keeps the number of files low.
        """
        if self.schema is not None:
            rows = align(rows, T.StructType.fromDDL(self.schema), ("table_name",))
        elif not set(self.order) <= set(rows.columns):
            raise ValueError("rows without order columns need a target with a declared schema")
        spark = rows.sparkSession
        layout = self._settled_layout(spark)
        full = self.with_bucket(self._own_names(rows).withColumn(DELETED, F.lit(False)), layout)
        hidden = (
            self._own_names(tenants.select(self.tenant))
            .distinct()
            .withColumn(BUCKET, F.explode(F.sequence(F.lit(0), layout.count(self.tenant) - 1)))
            .withColumn(DELETED, F.lit(True))
        )
        everything = full.unionByName(hidden, allowMissingColumns=True)
        if not by_tenant:
            everything = everything.hint("rebalance", *self.partitions)
        self._write(everything)
        if layout.version < 0:
            layout.store(spark, self.path)

    def merge(
        self,
        changes: DataFrame,
        op_col: str | None = None,
        delete_code: str = DELETE_CODE,
        broadcast_bytes: int = BROADCAST_BYTES,
        ignored: tuple[str, ...] = ("table_name",),
    ) -> None:
        """Apply changes to the partitions they touch, and leave the others alone.

        A column that the changes lack keeps its stored values. One that the
        table lacks raises, unless it is among ``ignored``.

        The newest change per key is written to the shared folder first: it is
        small next to the table, is used several times, and must not be read
        again from landing files. Applying the same changes again alters nothing.
        """
        if not self.keys or not self.order:
            raise ValueError("merging needs keys and order columns")
        spark = changes.sparkSession
        layout = self._settled_layout(spark)
        schema = self.stored_schema(spark)
        wanted = T.StructType([f for f in schema.fields if f.name not in (DELETED, BUCKET)])
        operation = [] if op_col is None else [T.StructField(op_col, T.StringType())]
        present = {name.lower() for name in changes.columns}
        needed = {name.lower() for name in (*self.row_key, *self.order, *([op_col] if op_col else []))}
        if needed - present:
            raise ValueError(f"changes without the columns {sorted(needed - present)}")
        kept = [f.name for f in wanted.fields if f.name.lower() not in present]
        data = self._own_names(align(changes, T.StructType([*wanted.fields, *operation]), ignored))
        newest = latest_change(with_deleted(data.drop(*kept), op_col, delete_code), self.row_key, self.order)
        ties = tie_columns(newest.schema, schema, self.row_key, self.order)
        newest = newest.withColumns({n: F.lit(None).cast(wanted[n].dataType) for n in kept})
        ready = self.with_bucket(newest.select(*wanted.fieldNames(), DELETED), layout)
        with staged(ready, "changes") as change:
            touched = self._touched(change)
            if touched.partitions == 0:
                return
            if touched.without_key:
                raise ValueError(f"{touched.without_key} changes without a value in {self.row_key}")
            if touched.spots is not None and len(touched.spots) <= MAX_FOLDER_LIST:
                base, files, size = self._touched_folders(spark, schema, touched.spots)
            else:
                base = self._in_partitions(self.read(spark), change, [BUCKET, self.tenant], touched.spots)
                files, size = self._touched_files(spark, change, touched)
            small = touched.bytes <= broadcast_bytes
            crowded = files > 2 * (touched.partitions + size / FILE_BYTES)
            merged = self._merged(base, change, small, crowded, ties, kept)
            with wide_shuffle(spark, size + touched.bytes):
                self._write(merged)
            if layout.version < 0:
                layout.store(spark, self.path)

    def _touched(self, change: DataFrame) -> Touched:
        """Size and partitions of the changes, counted in one pass."""
        no_key = F.expr(" or ".join(f"`{k}` is null" for k in self.row_key))
        per_spot = change.groupBy(F.concat_ws("/", BUCKET, self.tenant).alias("spot")).agg(
            F.sum(row_bytes(change)).alias("bytes"),
            F.count_if(no_key).alias("no_key"),
        )
        found = per_spot.limit(MAX_PARTITION_LIST + 1).collect()
        if len(found) > MAX_PARTITION_LIST:
            total = per_spot.agg(F.count(F.lit(1)), F.sum("bytes"), F.sum("no_key")).first()
            return Touched(*total, None)
        totals = [sum(row[name] for row in found) for name in ("bytes", "no_key")]
        return Touched(len(found), *totals, [row["spot"] for row in found])

    def _in_partitions(
        self, stored: DataFrame, wanted: DataFrame, on: list[str], spots: list[str] | None
    ) -> DataFrame:
        """Stored rows whose partition is among the wanted ones, named by ``spots`` if few."""
        if spots is None:
            return KeyList.of(wanted, on).keep(stored)
        # Only partition columns: decides which folders are read.
        return stored.where(F.concat_ws("/", *on).isin(spots))

    def _touched_folders(self, spark: SparkSession, schema: T.StructType, spots: list[str]) -> tuple[DataFrame, int, int]:
        """Stored rows of a few partitions, and their files and bytes; the table's other folders are not listed."""
        found = {}
        for spot in spots:
            number, name = spot.split("/", 1)
            folder = f"{self.path}/{partition_folder(spark, **{self.tenant: name, BUCKET: number})}"
            if (held := folder_files(spark, folder)) is not None:
                found[folder] = held
        if not found:
            return spark.createDataFrame([], schema), 0, 0
        rows = spark.read.schema(schema).option("basePath", self.path).parquet(*found)
        return rows, sum(n for n, _ in found.values()), sum(size for _, size in found.values())

    def _touched_files(self, spark: SparkSession, change: DataFrame, touched: Touched) -> tuple[int, int]:
        """Files and bytes of the touched partitions; contents are not read."""
        mine = self._in_partitions(
            self._files(spark), change, [BUCKET, self.tenant], touched.spots
        )
        files, size = mine.agg(F.count(F.lit(1)), F.sum("length")).first()
        return files, size or 0

    def _merged(
        self,
        base: DataFrame,
        change: DataFrame,
        small: bool,
        crowded: bool,
        ties: list[str],
        kept: list[str],
    ) -> DataFrame:
        """The stored rows with their changes, and the changes that are new rows.

        Small changes are broadcast, and the table itself is not shuffled. With
        others, stored rows are the left side of a join of two plain shuffles,
        which adaptive execution splits at a hot key, and their keys are made
        distinct before they are shuffled. So neither a repeated nor a missing
        key piles up in one task.

        A merge without a shuffle may add a file per partition for the new
        rows; ``crowded`` has all rows shuffled into fewer files.
        """
        key = self.row_key
        marked = change.withColumn("__change", F.lit(True))
        held = base.select(*key)
        if small:
            marked = F.broadcast(marked)
            held = held.join(F.broadcast(change.select(*key)), key, "left_semi")
        updated = choose_newer(
            base.alias("t").join(marked.alias("c"), same_key(key, "t", "c"), "left"),
            base.columns,
            [*key, BUCKET],
            self.order,
            True,
            ties,
            kept,
        )
        added = change.join(held.distinct(), key, "left_anti").select(*base.columns)
        if crowded or not small:
            return updated.unionByName(added).hint("rebalance", *self.partitions)
        return updated.unionByName(added.hint("rebalance", *self.partitions))
