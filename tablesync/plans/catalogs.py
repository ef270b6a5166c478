"""Targets and routes whose columns are those of the source's column catalog."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, types as T

from tablesync.config import MERGE_KEYS
from tablesync.operators.catalog import declared_schema
from tablesync.operators.widening import wider_schema
from tablesync.plans.changes import Route
from tablesync.sinks.appended import AppendedTable
from tablesync.sinks.target import TargetTable

TENANT = T.StructField("schema_name", T.StringType())


@dataclass(frozen=True)
class Shape:
    """What a column catalog does not say of a replicated table."""

    folder: str
    order: tuple[str, ...]
    #: Types of columns that only changes have, such as those of their order.
    extra: str = ""
    op_col: str | None = None
    keys: Mapping[str, Sequence[str]] | None = None

    def columns(self, catalog: DataFrame, name: str) -> T.StructType:
        """Columns of one table name over all tenants, wide enough for each of them."""
        declared = declared_schema(catalog, name)
        if not declared.fields:
            raise ValueError(f"the catalog has no columns of {name}")
        more = T.StructType.fromDDL(self.extra) if self.extra else T.StructType([])
        return wider_schema(declared, more)

    def target(self, catalog: DataFrame, name: str) -> TargetTable | AppendedTable:
        """The stored table of one name; without merge keys, rows are added."""
        schema = _ddl(T.StructType([*self.columns(catalog, name).fields, TENANT]))
        keys = (MERGE_KEYS if self.keys is None else self.keys).get(name.lower())
        path = f"{self.folder}/{name}"
        return TargetTable(path, tuple(keys), self.order, schema=schema) if keys else AppendedTable(path, schema)

    def route(self, catalog: DataFrame, name: str, fmt: str = "parquet", options: Mapping[str, str] | None = None) -> Route:
        """The target, and how landing files of that name are read.

        Files tell the types of their columns, if they are of a kind that does; text files are read as the target's.
        """
        target, read = self.target(catalog, name), self.columns(catalog, name)
        if self.op_col is not None and isinstance(target, TargetTable):
            read = T.StructType([*read.fields, T.StructField(self.op_col, T.StringType())])
        return Route(target, read, self.op_col, fmt=fmt, options=options or {})


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
