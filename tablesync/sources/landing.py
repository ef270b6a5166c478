"""Files of changes, laid out as ``<prefix>/<tenant>/<table>/...``."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tablesync.config import SCHEMA_POSITION, TABLE_POSITION
from tablesync.functions.names import path_part
from tablesync.operators.batches import index_paths


def below_root(path: Column | str, root: str) -> Column:
    """A file's path from the last folder of ``root`` on, without the scheme."""
    plain = F.regexp_replace(path, "^[a-zA-Z][a-zA-Z0-9+.-]*:/+", "/")
    bare = "/" + root.split("://")[-1].removeprefix("file:").strip("/")
    parent = bare.rsplit("/", 1)[0] + "/"
    at = F.instr(plain, parent)
    outside = F.raise_error(F.concat(F.lit(f"not below {root}: "), plain))
    return F.when(at > 0, F.substring(plain, at + len(parent), F.length(plain))).otherwise(outside)


def decoded(path: Column) -> Column:
    """A path from ``_metadata`` as it is on disk; those are URL-encoded, but for the plus sign."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def landing_index(
    spark: SparkSession,
    root: str,
    schema_pos: int = SCHEMA_POSITION,
    table_pos: int = TABLE_POSITION,
) -> DataFrame:
    """Path, length and time of every landing file, with its tenant and table.

    Positions count from 1 at the last folder of ``root``. Contents are not read.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select(below_root("path", root).alias("path"), "length", "modificationTime")
    )
    return index_paths(files, schema_pos, table_pos)


def listed_files(
    spark: SparkSession,
    root: str,
    schema_pos: int = SCHEMA_POSITION,
    table_pos: int = TABLE_POSITION,
) -> DataFrame:
    """``path, length, modified, place, schema_name, table_name`` of every landing file, in one listing.

    ``path`` can be read, ``place`` is what lies below the root's parent. Names
    are in lower case; files whose name starts with a dot or an underscore are not data.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", "length", F.col("modificationTime").alias("modified"), below_root("path", root).alias("place"))
    )
    named = files.withColumns(
        {"schema_name": F.lower(path_part("place", schema_pos)), "table_name": F.lower(path_part("place", table_pos))}
    )
    return named.where(~F.element_at(F.split("path", "/"), -1).rlike("^[._]"))


def read_files(
    spark: SparkSession,
    paths: Sequence[str],
    root: str,
    schema: str | T.StructType,
    fmt: str = "parquet",
    schema_pos: int = SCHEMA_POSITION,
    table_pos: int = TABLE_POSITION,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Changes of the given landing files, with tenant and table; no other file is listed."""
    plain = [re.sub(r"([\\*?\[\]{}])", r"\\\1", path) for path in paths]
    reader = spark.read.format(fmt).schema(schema).options(**(options or {}))
    return with_place(reader.option("recursiveFileLookup", "true").load(plain), root, schema_pos, table_pos)


def with_place(
    changes: DataFrame,
    root: str,
    schema_pos: int = SCHEMA_POSITION,
    table_pos: int = TABLE_POSITION,
) -> DataFrame:
    """Add tenant and table from the path of the file each row was read from."""
    place = below_root(decoded(F.col("_metadata.file_path")), root)
    return changes.withColumns(
        {
            "schema_name": F.lower(path_part(place, schema_pos)),
            "table_name": F.lower(path_part(place, table_pos)),
        }
    )


def table_glob(
    root: str,
    table: str,
    schema_pos: int = SCHEMA_POSITION,
    table_pos: int = TABLE_POSITION,
) -> str:
    """A path pattern for the files of one table name, in any case, across all tenants."""
    if not 1 < schema_pos < table_pos:
        raise ValueError("the tenant has to come after the root and before the table")
    letters = [f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in table]
    return "/".join([root.rstrip("/"), *["*"] * (table_pos - 2), "".join(letters)])


def read_changes(
    spark: SparkSession,
    root: str,
    schema: str | T.StructType,
    fmt: str = "parquet",
    table: str | None = None,
    schema_pos: int = SCHEMA_POSITION,
    table_pos: int = TABLE_POSITION,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Changes of all landing files, or of one table name, with tenant and table."""
    path = root if table is None else table_glob(root, table, schema_pos, table_pos)
    reader = spark.read.format(fmt).schema(schema).options(**(options or {}))
    rows = reader.option("recursiveFileLookup", "true").load(path)
    return with_place(rows, root, schema_pos, table_pos)
