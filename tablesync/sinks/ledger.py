"""Which landing files are applied: remembered by file, in tables of their own.

A run is first *planned* (its files are written down), then applied table by
table; each table's files are *closed* when its rows are in the target. A run that
breaks off is taken up again with the same files and the same name, so a target
that writes by run (:class:`~tablesync.sinks.appended.AppendedTable`) or merges by key
has each file once.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablesync.session import child_folders, delete_folder, folder_exists, move_file
from tablesync.sinks.tables import replace_folder
from tablesync.sources.frames import empty_frame

#: What makes a file the same file; a new version of it has another length or time.
IDENTITY = ("path", "length", "modified")
ENTRY = "run string, table_name string, schema_name string, path string, length long, modified timestamp"


@dataclass(frozen=True)
class FileLedger:
    """Applied and planned landing files below ``path``; one job at a time may write it."""

    path: str

    def _entries(self, spark: SparkSession, folder: str) -> DataFrame:
        if not folder_exists(spark, folder):
            return empty_frame(spark, ENTRY)
        return spark.read.schema(ENTRY).option("recursiveFileLookup", "true").parquet(folder)

    def closed(self, spark: SparkSession) -> DataFrame:
        """Files whose rows are in their targets."""
        return self._entries(spark, f"{self.path}/closed")

    def planned(self, spark: SparkSession, run: str | None = None) -> DataFrame:
        """Files of the runs that are not finished, or of one of them."""
        return self._entries(spark, f"{self.path}/planned" + (f"/run={run}" if run else ""))

    def open_runs(self, spark: SparkSession) -> list[str]:
        """Names of the runs that are not finished, oldest name first."""
        found = child_folders(spark, f"{self.path}/planned")
        return sorted(name.removeprefix("run=") for name in found if name.startswith("run="))

    def fresh(self, files: DataFrame) -> DataFrame:
        """Those of ``files`` that no run has applied or planned."""
        spark = files.sparkSession
        known = self.closed(spark).union(self.planned(spark)).select(*IDENTITY)
        return files.join(known, list(IDENTITY), "left_anti")

    def plan(self, files: DataFrame, run: str) -> None:
        """Write down the files of a run; they are few enough for one file, so all of them are there or none."""
        entries = files.withColumn("run", F.lit(run)).select(*[c.split()[0] for c in ENTRY.split(", ")])
        entries.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/planned/run={run}")

    def close(self, spark: SparkSession, run: str, table: str) -> None:
        """The run's files of one table are applied."""
        mine = self.planned(spark, run).where(F.col("table_name") == table)
        mine.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/closed/run={run}/table={quote(table, safe='')}")

    def finish(self, spark: SparkSession, run: str) -> None:
        """All tables of the run are closed."""
        delete_folder(spark, f"{self.path}/planned/run={run}")

    def archive(self, files: DataFrame, root: str, archive: str) -> int:
        """Move those of ``files`` that are applied below ``archive``, by run; return how many.

        Files are moved by name, one after another, and are not read; what a
        run that broke off has left in place is moved by the next one.
        """
        spark = files.sparkSession
        applied = self.closed(spark).select("run", *IDENTITY).dropDuplicates(list(IDENTITY))
        moved = 0
        for row in files.join(applied, list(IDENTITY)).select("run", "path", "place").toLocalIterator():
            move_file(spark, row["path"], f"{archive}/run={row['run']}/{row['place']}")
            moved += 1
        return moved

    def compact(self, files: DataFrame) -> None:
        """Forget applied files that are no longer among ``files``; the ledger stays as long as the landing folder."""
        spark = files.sparkSession
        if folder_exists(spark, f"{self.path}/closed"):
            kept = self.closed(spark).join(files.select(*IDENTITY), list(IDENTITY), "left_semi")
            replace_folder(kept.select(*[c.split()[0] for c in ENTRY.split(", ")]), f"{self.path}/closed")


def first_files(files: DataFrame, most: int, tables: Iterable[str]) -> DataFrame:
    """At most ``most`` files of the named tables, the oldest first."""
    mine = files.where(F.col("table_name").isin(list(tables)))
    return mine.orderBy("modified", "path").limit(most)
