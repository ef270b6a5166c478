"""Reading and writing databases through Spark's JDBC source or a vendor connector."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablesync.config import TENANT_BATCH
from tablesync.functions.names import lower_columns, quote_identifier, quote_literal, same_name
from tablesync.operators.checksums import ChecksumSql, Compared, Dialect, FrameSide
from tablesync.operators.keys import KeyList
from tablesync.sources.growing import Growing, between_queries, high_query

TENANT = "schema_name"


@dataclass(frozen=True)
class Connection:
    """Where a database is: connector options, by default those of JDBC.

    ``quote`` is the database's identifier quote, such as a backtick for MySQL.
    """

    options: Mapping[str, str]
    format: str = "jdbc"
    quote: str = '"'
    fetch: Mapping[str, str] = field(default_factory=lambda: {"fetchsize": "10000"})

    def reader(self, spark: SparkSession):
        return spark.read.format(self.format).options(**{**self.fetch, **self.options})

    def writer(self, df: DataFrame, mode: str):
        return df.write.format(self.format).options(**self.options).mode(mode)


def read_table(spark: SparkSession, conn: Connection, dbtable: str) -> DataFrame:
    """A whole table or catalog view; filters and columns are pushed down by Spark."""
    return conn.reader(spark).option("dbtable", dbtable).load()


def read_query(spark: SparkSession, conn: Connection, query: str) -> DataFrame:
    """The result of a query that the database runs."""
    return conn.reader(spark).option("query", query.strip().rstrip(";")).load()


def read_snapshot(
    spark: SparkSession,
    conn: Connection,
    table: str,
    partition_column: str,
    bounds: tuple[object, object],
    num_partitions: int,
) -> DataFrame:
    """All rows of a table, read in equal ranges of an evenly spread column."""
    return (
        conn.reader(spark)
        .option("dbtable", table)
        .option("partitionColumn", partition_column)
        .option("lowerBound", str(bounds[0]))
        .option("upperBound", str(bounds[1]))
        .option("numPartitions", str(num_partitions))
        .load()
    )


def _literal(key: object) -> str:
    """A key as SQL text."""
    if isinstance(key, str):
        return quote_literal(key)
    if isinstance(key, datetime):
        return f"TIMESTAMP '{key:%Y-%m-%d %H:%M:%S.%f}'"
    return f"DATE '{key}'" if isinstance(key, date) else str(key)


def probe_query(table: str, column: str, after: object = None, skip: int = 0) -> str:
    """SQL for the key ``skip`` rows after the first one beyond ``after``, in the database's own order of keys.

    An index on the column is read from there on, and nothing is sorted.
    """
    beyond = f"{column} IS NOT NULL" if after is None else f"{column} > {_literal(after)}"
    return f"SELECT {column} AS first_key FROM {table} WHERE {beyond} ORDER BY {column} LIMIT 1 OFFSET {skip}"


def find_splits(
    spark: SparkSession, conn: Connection, table: str, column: str, tenants: Iterable[str], rows: int
) -> dict[tuple[str, str], list[object]]:
    """First keys of the ranges to read large tenants in, of about ``rows`` rows each.

    For ``DatabaseTables.splits``. The keys are found step by step along the
    column's index, one short query a range. Rows of one key are never parted, so a key with more rows
    makes its range that much larger.
    """
    found = {}
    for tenant in tenants:
        full_name = quote_identifier(tenant, table, quote=conn.quote)
        keys: list[object] = []
        while True:
            query = probe_query(full_name, column, keys[-1] if keys else None, rows - 1 if keys else 0)
            row = lower_columns(read_query(spark, conn, query)).first()
            if row is None:
                break
            keys.append(row["first_key"])
        found[table, tenant] = keys
    return found


def range_predicates(column: str, first_keys: Sequence[object]) -> list[str]:
    """Predicates that cover every row once: below, between and above the keys.

    ``first_keys`` come in the database's order, which need not be Python's.
    Rows with a null in ``column`` go with the first range.
    """
    cuts = list(dict.fromkeys(k for k in first_keys if k is not None))[1:]
    text = [_literal(k) for k in cuts]
    if not text:
        return ["1 = 1"]
    middle = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(text, text[1:])]
    return [f"({column} < {text[0]} OR {column} IS NULL)", *middle, f"{column} >= {text[-1]}"]


def tenants_query(conn: Connection, table: str, tenants: Iterable[str]) -> str:
    """SQL for one table name across tenants, the tenant as a column."""
    parts = [
        f"SELECT {quote_literal(tenant)} AS {TENANT}, t.* "
        f"FROM {quote_identifier(tenant, table, quote=conn.quote)} t"
        for tenant in tenants
    ]
    return " UNION ALL ".join(parts)


def count_query(query: str) -> str:
    """SQL for the rows per tenant of a :func:`tenants_query`."""
    return f"SELECT {TENANT}, COUNT(*) AS n_source FROM ({query}) tenants GROUP BY {TENANT}"


@dataclass(frozen=True)
class DatabaseTables:
    """The tenants' tables of a database, one frame per table name.

    Small tenants are read ``batch`` at a time by one query, a partition of the
    read. ``splits`` lists, per table and tenant, the first keys of the ranges a
    large tenant is read in (see :func:`find_splits`); each range is a query of
    its own. So the database reads every row once, and no task a large tenant whole.
    Needs the JDBC connector, which takes one predicate per partition.
    """

    spark: SparkSession
    conn: Connection
    split_columns: Mapping[str, str] = field(default_factory=dict)
    splits: Mapping[tuple[str, str], Sequence[object]] = field(default_factory=dict)
    batch: int = TENANT_BATCH
    # A partition may hold rows of several tenants.
    by_tenant: bool = False
    #: How the database spells checksums, and the decimals of fractions that count; without it none are compared.
    dialect: Dialect | None = None
    digits: int = 6

    def reads(self, table: str, tenants: DataFrame) -> Iterator[tuple[str, list[str]]]:
        """SQL text, and a predicate for each partition that it is read in."""
        small: list[str] = []
        for row in tenants.select(TENANT).distinct().toLocalIterator():
            name = row[TENANT]
            if keys := self.splits.get((table, name)):
                yield tenants_query(self.conn, table, [name]), range_predicates(self.split_columns[table], keys)
                continue
            small.append(name)
            if len(small) == self.batch:
                yield tenants_query(self.conn, table, small), ["1 = 1"]
                small = []
        if small:
            yield tenants_query(self.conn, table, small), ["1 = 1"]

    def table(self, name: str, tenants: DataFrame) -> DataFrame:
        """All rows of the table ``name`` of the given tenants."""
        properties = {**self.conn.fetch, **self.conn.options}
        url = properties.pop("url")
        frames = [
            self.spark.read.jdbc(url, f"({query}) tenants", predicates=parts, properties=properties)
            for query, parts in self.reads(name, tenants)
        ]
        return reduce(DataFrame.unionByName, frames)

    def counts(self, name: str, tenants: DataFrame) -> DataFrame:
        """Rows per tenant, counted by the database."""
        frames = [
            lower_columns(read_query(self.spark, self.conn, count_query(query)))
            for query, _ in self.reads(name, tenants)
        ]
        return reduce(DataFrame.unionByName, frames)


    def sums(self, name: str, tenants: DataFrame, rows: DataFrame) -> tuple[Compared, DataFrame] | None:
        """Checksums per tenant, formed by the database, and how to form those of ``rows`` that were read from it."""
        if self.dialect is None:
            return None
        what = Compared.of(rows, (), [TENANT], self.digits)
        sql = ChecksumSql(name, what, self.dialect, self.conn.quote)
        names = [row[TENANT] for row in tenants.select(TENANT).distinct().toLocalIterator()]
        queries = [sql.sums(dict.fromkeys(names[i : i + self.batch]), 0) for i in range(0, len(names), self.batch)]
        frames = [lower_columns(read_query(self.spark, self.conn, query)) for query in queries]
        return what, reduce(DataFrame.unionByName, frames)


    def highs(self, name: str, tenants: DataFrame, growing: Growing) -> DataFrame:
        """The highest value of a growing column by tenant."""
        names = [row[TENANT] for row in tenants.select(TENANT).distinct().toLocalIterator()]
        queries = [
            high_query(name, names[i : i + self.batch], growing, self.conn.quote) for i in range(0, len(names), self.batch)
        ]
        found = reduce(DataFrame.unionByName, [lower_columns(read_query(self.spark, self.conn, q)) for q in queries])
        return found.select(TENANT, growing.text(F.col("high")).alias("high"))

    def between(self, name: str, bounds: DataFrame, growing: Growing) -> DataFrame:
        """Rows between the bounds of each tenant, several tenants a partition."""
        queries = list(between_queries(name, bounds, growing, self.conn.quote))
        frames = [
            read_query(self.spark, self.conn, " UNION ALL ".join(queries[i : i + self.batch]))
            for i in range(0, len(queries), self.batch)
        ]
        return reduce(DataFrame.unionByName, frames)


@dataclass(frozen=True)
class FrameTables:
    """Tenants' tables that are already frames with a tenant column, by table name."""

    frames: Mapping[str, DataFrame]
    by_tenant: bool = False

    def table(self, name: str, tenants: DataFrame) -> DataFrame:
        """All rows of the table ``name`` of the given tenants, compared without case."""
        listed = KeyList.of(tenants.select(same_name(TENANT).alias("__tenant")), ["__tenant"])
        return listed.keep(self.frames[name].withColumn("__tenant", same_name(TENANT))).drop(
            "__tenant"
        )

    def counts(self, name: str, tenants: DataFrame) -> DataFrame:
        """Rows per tenant."""
        return self.table(name, tenants).groupBy(TENANT).agg(F.count(F.lit(1)).alias("n_source"))

    def sums(self, name: str, tenants: DataFrame, rows: DataFrame) -> tuple[Compared, DataFrame]:
        """Checksums per tenant, and how to form those of ``rows``."""
        what = Compared.of(rows, (), [TENANT])
        return what, FrameSide(self.table(name, tenants)).sums(what, 0)
