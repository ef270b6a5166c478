"""How far each tenant's table has been read."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablesync.session import folder_exists
from tablesync.sinks.tables import replace_folder
from tablesync.sources.frames import empty_frame

TENANT = "schema_name"
MARK = f"{TENANT} string, mark string"


@dataclass(frozen=True)
class Bookmark:
    """Stored marks by table name and tenant, below ``path``."""

    path: str

    def _folder(self, table: str) -> str:
        return f"{self.path}/table={quote(table.lower(), safe='')}"

    def marks(self, spark: SparkSession, table: str) -> DataFrame:
        """``schema_name, mark`` of the tenants that were read; tenants in lower case."""
        folder = self._folder(table)
        if not folder_exists(spark, folder):
            return empty_frame(spark, MARK)
        return spark.read.schema(MARK).parquet(folder)

    def advance(self, table: str, marks: DataFrame) -> None:
        """Keep ``marks``; those of other tenants, and of tenants without a value, stay."""
        spark = marks.sparkSession
        new = marks.select(F.lower(TENANT).alias(TENANT), F.col("mark").alias("__new")).where("mark is not null")
        both = self.marks(spark, table).join(new, TENANT, "full_outer")
        replace_folder(both.select(TENANT, F.coalesce("__new", "mark").alias("mark")), self._folder(table))

    def reset(self, spark: SparkSession, table: str, tenants: Iterable[str]) -> None:
        """Have tenants read whole the next time, such as after rows older than the overlap came in."""
        left = self.marks(spark, table).where(~F.col(TENANT).isin([t.lower() for t in tenants]))
        replace_folder(left, self._folder(table))
