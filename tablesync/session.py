"""Session settings, and the shared folder in which lineage is cut."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from tablesync.config import FILE_BYTES, MAX_SHUFFLE_PARTITIONS

# Settings the jobs are tuned for; a session that brings its own keeps them.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A skewed join is split even where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Joins whose measured build partitions are small skip the sort.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # File listings and reads of tenants stay column-pruned and filtered.
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app: str, **conf: str) -> SparkSession:
    """Start (or get) a session with :data:`RECOMMENDED`; ``conf`` wins over it."""
    builder = SparkSession.builder.appName(app)
    for name, value in {**RECOMMENDED, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it.

    Only a local session may do without ``spark.checkpoint.dir``; it gets a
    temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tablesync-"))
    return context.getCheckpointDir().rstrip("/")


def reliable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there.

    The result is computed once and does not change when an executor is lost.
    """
    spark = df.sparkSession
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is something at ``path``."""
    system, folder = _folder(spark, path)
    return system.exists(folder)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path``."""
    system, folder = _folder(spark, path)
    if not system.exists(folder):
        return []
    return [entry.getPath().getName() for entry in system.listStatus(folder) if entry.isDirectory()]


def partition_folder(spark: SparkSession, **values: object) -> str:
    """The folder of a partition, as Spark names it below a table's own."""
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return "/".join(f"{name}={escape(str(value))}" for name, value in values.items())


def folder_files(spark: SparkSession, path: str) -> tuple[int, int] | None:
    """Number and bytes of the data files right in a folder; None if there is no such folder."""
    system, folder = _folder(spark, path)
    if not system.exists(folder):
        return None
    sizes = [e.getLen() for e in system.listStatus(folder) if e.isFile() and e.getPath().getName()[0] not in "._"]
    return len(sizes), sum(sizes)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove ``path`` and what is below it."""
    system, folder = _folder(spark, path)
    system.delete(folder, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that is there whole or not at all; one of that name is not replaced."""
    system, target = _folder(spark, path)
    new = _folder(spark, f"{path}.{uuid.uuid4().hex}.new")[1]
    out = system.create(new)
    out.write(bytearray(text.encode()))
    out.close()
    if system.exists(target) or not system.rename(new, target):
        system.delete(new, False)
        raise OSError(f"{path} is there already")


def read_last_text(spark: SparkSession, folder: str, suffix: str) -> tuple[str, str] | None:
    """Name and text of the small file that comes last by name."""
    system, place = _folder(spark, folder)
    if not system.exists(place):
        return None
    found = [entry for entry in system.listStatus(place) if entry.getPath().getName().endswith(suffix)]
    if not found:
        return None
    last = max(found, key=lambda entry: entry.getPath().getName())
    source = system.open(last.getPath())
    try:
        return last.getPath().getName(), bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def move_file(spark: SparkSession, path: str, to: str) -> None:
    """Move a file, into folders that are made if they are not there."""
    system, source = _folder(spark, path)
    target = _folder(spark, to)[1]
    system.mkdirs(target.getParent())
    if not system.rename(source, target):
        raise OSError(f"{path} could not be moved to {to}")


@contextmanager
def adaptive(spark: SparkSession) -> Iterator[None]:
    """Adaptive execution in a block; a stream's own session may have it off."""
    name = "spark.sql.adaptive.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def wide_shuffle(spark: SparkSession, data_bytes: int) -> Iterator[None]:
    """Have enough shuffle partitions for ``data_bytes`` of stored data in a block.

    Adaptive execution joins partitions that turn out small, but cannot make
    more of them than the session starts with.
    """
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    needed = min(data_bytes // FILE_BYTES, MAX_SHUFFLE_PARTITIONS)
    spark.conf.set(name, str(max(int(before), needed)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def staged(df: DataFrame, label: str, keep_on_error: bool = False) -> Iterator[DataFrame]:
    """Write ``df`` as a table in the shared folder for the length of a block.

    ``keep_on_error`` leaves the table there if the block fails, for blocks
    that may have removed the only other copy by then.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    keep = False
    try:
        yield spark.read.schema(df.schema).parquet(path)
    except BaseException as error:
        keep = keep_on_error
        if keep:
            error.add_note(f"all rows are still in {path}")
        raise
    finally:
        if not keep:
            system, folder = _folder(spark, path)
            system.delete(folder, True)
