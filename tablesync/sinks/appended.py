"""A replicated table without keys: rows are added, each run once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tablesync.operators.cdc import align
from tablesync.session import folder_exists
from tablesync.sources.frames import empty_frame

RUN = "run"


@dataclass(frozen=True)
class AppendedTable:
    """One table name across all tenants, parquet by tenant and run.

    A run that is repeated overwrites what it wrote the first time, so its rows
    are there once. Tenant names are stored in lower case.
    """

    path: str
    schema: str
    tenant: str = "schema_name"

    def _stored(self) -> T.StructType:
        kept = [f for f in T.StructType.fromDDL(self.schema).fields if f.name not in (self.tenant, RUN)]
        return T.StructType(
            [*kept, T.StructField(self.tenant, T.StringType()), T.StructField(RUN, T.StringType())]
        )

    def append(self, rows: DataFrame, run: str, ignored: tuple[str, ...] = ("table_name",)) -> None:
        """Add the rows of a run, or put them in place of those it wrote before."""
        stored = self._stored()
        aligned = align(rows.withColumn(RUN, F.lit(run)), stored, ignored)
        empty = F.raise_error(F.lit(f"a row with an empty {self.tenant}"))
        name = F.when(F.coalesce(F.col(self.tenant), F.lit("")) == "", empty).otherwise(F.lower(self.tenant))
        (
            aligned.withColumn(self.tenant, name)
            .hint("rebalance", self.tenant)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(self.tenant, RUN)
            .parquet(self.path)
        )

    def current(self, spark: SparkSession) -> DataFrame:
        """All rows, without the run they came with."""
        stored = self._stored()
        if not folder_exists(spark, self.path):
            return empty_frame(spark, stored).drop(RUN)
        return spark.read.schema(stored).parquet(self.path).drop(RUN)
