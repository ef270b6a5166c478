"""The log of all runs: what each did with each tenant's table, and what is to be done again."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablesync.functions.names import same_name
from tablesync.operators.control import FAILED
from tablesync.session import folder_exists
from tablesync.sources.frames import empty_frame

RUN_LOG = "app_id string, table_name string, status string, message string"
HISTORY = f"{RUN_LOG}, run string, at timestamp"


@dataclass(frozen=True)
class RunHistory:
    """Run logs below ``path``, a folder a run; earlier runs are never written again."""

    path: str

    def record(self, log: DataFrame, run: str, at: datetime, part: str = "") -> None:
        """Add rows of a run; the same ``part`` of the same run is replaced."""
        stamped = log.select(
            "app_id", "table_name", "status", "message", F.lit(run).alias("run"), F.lit(at).cast("timestamp").alias("at")
        )
        folder = f"{self.path}/run={quote(run, safe='')}"
        stamped.write.mode("overwrite").parquet(f"{folder}/part={quote(part, safe='')}" if part else folder)

    def _read(self, spark: SparkSession, folder: str) -> DataFrame:
        if not folder_exists(spark, folder):
            return empty_frame(spark, HISTORY)
        return spark.read.schema(HISTORY).option("recursiveFileLookup", "true").parquet(folder)

    def rows(self, spark: SparkSession) -> DataFrame:
        """What all runs did, with name and time of the run."""
        return self._read(spark, self.path)

    def of(self, spark: SparkSession, run: str) -> DataFrame:
        """The log of one run, as it was recorded."""
        return self._read(spark, f"{self.path}/run={quote(run, safe='')}").select("app_id", "table_name", "status", "message")

    def latest(self, spark: SparkSession) -> DataFrame:
        """The state of each tenant's table after the last run that had it, whatever the case of its name.

        Of one run, a failure outweighs what else is said of the table.
        """
        newest = F.max(F.struct("at", "run", (F.col("status") == FAILED).alias("failed"), "status", "message"))
        found = self.rows(spark).groupBy(F.lower("app_id").alias("app_id"), F.lower("table_name").alias("table_name"))
        return found.agg(newest.alias("last")).select(
            "app_id", "table_name", "last.status", "last.message", "last.run", "last.at"
        )

    def retry_plan(self, spark: SparkSession) -> DataFrame:
        """``schema_name, table_name`` of what failed when it was last tried: a plan for ``load_tables``."""
        return self.latest(spark).where(F.col("status") == FAILED).select(F.col("app_id").alias("schema_name"), "table_name")

    def summary(self, spark: SparkSession) -> DataFrame:
        """Per tenant: runs, tables that are in order now, and tables that are not."""
        runs = self.rows(spark).groupBy(same_name("app_id").alias("__app")).agg(F.count_distinct("run").alias("n_runs"))
        now = self.latest(spark).groupBy("app_id").agg(
            F.count_if(F.col("status") != FAILED).alias("n_ok"), F.count_if(F.col("status") == FAILED).alias("n_failed")
        )
        return now.join(runs, same_name("app_id") == F.col("__app")).select("app_id", "n_runs", "n_ok", "n_failed")
