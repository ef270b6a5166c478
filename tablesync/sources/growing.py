"""What has been added to tenants' tables since they were last read.

A read covers what lies between the last read's highest value of a column (less
an overlap, for rows that were committed late) and the highest value there is
now. That value is asked for before the rows are, so nothing that is added in between
is passed over. Rows of the overlap come again; the target keeps one by key.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass
from datetime import datetime, timedelta
from typing import Protocol

from pyspark.sql import Column, DataFrame, functions as F

from tablesync.functions.names import quote_identifier, quote_literal, same_name

TENANT = "schema_name"
#: The form in which times are kept and written into SQL.
TIME = "%Y-%m-%d %H:%M:%S.%f"


@dataclass(frozen=True)
class Growing:
    """The column whose values grow, and how far back late rows may lie: a number, or a time span."""

    column: str
    overlap: int | timedelta = 0

    @property
    def is_time(self) -> bool:
        return isinstance(self.overlap, timedelta)

    def low(self, mark: str) -> str:
        """The value from which on to read after ``mark``."""
        if self.is_time:
            return (datetime.strptime(mark, TIME) - self.overlap).strftime(TIME)
        return str(int(mark) - self.overlap)

    def low_column(self, mark: Column) -> Column:
        """:meth:`low` of a column of marks, as a value of the column's type."""
        if self.is_time:
            return mark.cast("timestamp_ntz") - F.lit(self.overlap)
        return mark.cast("decimal(20,0)") - F.lit(self.overlap)

    def text(self, value: Column) -> Column:
        """A value in the form marks are kept in."""
        if self.is_time:
            return F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        return value.cast("string")

    def literal(self, value: str) -> str:
        return f"TIMESTAMP {quote_literal(value)}" if self.is_time else value

    def predicate(self, low: str | None, high: str | None, quote: str = '"') -> str:
        """SQL for the rows of a read; a first read has no lower bound and takes rows without a value, too.

        A table without any value is read whole each time.
        """
        name = quote_identifier(self.column, quote=quote)
        if high is None:
            return "1 = 1"
        upper = f"{name} <= {self.literal(high)}"
        if low is None:
            return f"({upper} OR {name} IS NULL)"
        return f"{name} >= {self.literal(low)} AND {upper}"


class GrowingTables(Protocol):
    """Where the rows of a table name come from, for several tenants at once."""

    def highs(self, name: str, tenants: DataFrame, growing: Growing) -> DataFrame: ...

    def between(self, name: str, bounds: DataFrame, growing: Growing) -> DataFrame: ...


def bounds_of(tenants: DataFrame, marks: DataFrame, highs: DataFrame) -> DataFrame:
    """``schema_name, mark, high`` of each tenant to be read: those that are new or have grown.

    One whose highest value is the mark is read again only for its overlap, so it is listed as well.
    """
    listed = tenants.select(TENANT).distinct().withColumn("__same", same_name(TENANT))
    left = marks.select(same_name(TENANT).alias("__marked"), "mark")
    right = highs.select(same_name(TENANT).alias("__high"), "high")
    return (
        listed.join(left, F.col("__same") == F.col("__marked"), "left")
        .join(right, F.col("__same") == F.col("__high"), "left")
        .select(TENANT, "mark", "high")
    )


@dataclass(frozen=True)
class GrowingFrames:
    """Tables that are already frames with a tenant column, by table name."""

    frames: Mapping[str, DataFrame]

    def highs(self, name: str, tenants: DataFrame, growing: Growing) -> DataFrame:
        highest = self.frames[name].groupBy(TENANT).agg(F.max(growing.column).alias("high"))
        return highest.select(TENANT, growing.text(F.col("high")).alias("high"))

    def between(self, name: str, bounds: DataFrame, growing: Growing) -> DataFrame:
        kind = "timestamp_ntz" if growing.is_time else "decimal(20,0)"
        rows, value = self.frames[name], F.col(f"`{growing.column}`")
        limits = bounds.select(
            same_name(TENANT).alias("__tenant"),
            growing.low_column(F.col("mark")).alias("__low"),
            F.col("high").cast(kind).alias("__high"),
        )
        first = F.col("__low").isNull()
        wanted = F.col("__high").isNull() | ((value <= F.col("__high")) & (first | (value >= F.col("__low")))) | (first & value.isNull())
        return rows.join(limits, (same_name(TENANT) == F.col("__tenant")) & wanted).select(*rows.columns)


def high_query(table: str, tenants: Iterable[str], growing: Growing, quote: str = '"') -> str:
    """SQL for the highest value of each tenant's table; an index on the column answers it."""
    name = quote_identifier(growing.column, quote=quote)
    parts = [
        f"SELECT {quote_literal(t)} AS {TENANT}, MAX({name}) AS high FROM {quote_identifier(t, table, quote=quote)}"
        for t in tenants
    ]
    return " UNION ALL ".join(parts)


def between_queries(table: str, bounds: DataFrame, growing: Growing, quote: str = '"') -> Iterator[str]:
    """SQL for what each tenant has to read; a tenant without a change still has its overlap read."""
    for row in bounds.toLocalIterator():
        low = None if row["mark"] is None else growing.low(row["mark"])
        yield (
            f"SELECT {quote_literal(row[TENANT])} AS {TENANT}, t.* FROM {quote_identifier(row[TENANT], table, quote=quote)} t "
            f"WHERE {growing.predicate(low, row['high'], quote)}"
        )
