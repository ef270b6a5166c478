"""Comparing large tables by checksums of buckets, and only what differs row by row.

A row's bucket is the first bits of a hash of its keys, so the buckets of a
coarse level are those of a finer one put together. A bucket's checksum is the
number of its rows and two sums of hashes of whole rows: it does not depend on
their order, and repeated rows count as often as they occur. All of it is plain
SQL over a text form of the values, so a database can work it out where its rows
are (:class:`DatabaseSide`), and hands over one row a bucket.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tablesync.config import MAX_PARTITION_LIST, TENANT_BATCH
from tablesync.functions.names import lower_columns, quote_identifier, quote_literal
from tablesync.operators.keys import KeyList
from tablesync.operators.reconcile import reconcile_rows
from tablesync.session import reliable
from tablesync.sources.frames import empty_frame

#: Bits of a bucket's number by level.
LEVELS = (8, 16)
#: Bits of the number that buckets are the first bits of.
WIDE = 32
SUMS = ("n", "one", "two")


@dataclass(frozen=True)
class Compared:
    """What is compared: groups ``by``, ``keys`` within them, and all columns (without ``by``) with their types.

    Fractions are compared to ``digits`` decimals where checksums are formed, and exactly by
    row; None forms checksums of the exact value, which only Spark spells alike.
    """

    by: tuple[str, ...]
    keys: tuple[str, ...]
    schema: T.StructType
    digits: int | None = None

    @classmethod
    def of(cls, rows: DataFrame, keys: Sequence[str], by: Sequence[str] = (), digits: int | None = None) -> Compared:
        kept = [f for f in rows.schema.fields if f.name not in by]
        return cls(tuple(by), tuple(keys), T.StructType(kept), digits)

    def key_fields(self) -> list[T.StructField]:
        return [self.schema[name] for name in self.keys]


@dataclass(frozen=True)
class Groups:
    """Buckets of a level, with the group each belongs to."""

    frame: DataFrame
    bits: int


class Side(Protocol):
    """One of the tables: its checksums, and its rows of some buckets."""

    def sums(self, what: Compared, bits: int, within: Groups | None) -> DataFrame: ...

    def rows(self, what: Compared, within: Groups) -> DataFrame: ...


# In Spark ---------------------------------------------------------------------


def _text(fields: Sequence[T.StructField], digits: int | None) -> Column:
    """Values as one text that no other values have: each with its length, or marked as null."""
    parts = []
    for field in fields:
        value = F.col(f"`{field.name}`")
        kind = field.dataType
        if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType) and digits is not None:
            value = value.try_cast(f"decimal(38,{digits})")
        elif isinstance(kind, T.DecimalType):
            value = value.cast(f"decimal(38,{kind.scale})")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            value = F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(kind, T.BooleanType):
            value = F.when(value, "1").when(~value, "0")
        elif isinstance(kind, T.BinaryType):
            value = F.hex(value)
        text = value.cast("string")
        marked = F.concat(F.lit("v"), F.length(text).cast("string"), F.lit(":"), text)
        parts.append(F.when(text.isNull(), "n").otherwise(marked))
    return F.concat(*parts)


def _number(hashed: Column, start: int) -> Column:
    """Eight hexadecimal digits of a hash as a number."""
    return F.conv(F.substring(hashed, start, 8), 16, 10).cast("long")


def bucket(what: Compared, bits: int) -> Column:
    """The number of a row's bucket; without bits, all rows are one bucket."""
    if not bits:
        return F.lit(0).cast("long")
    return F.shiftright(_number(F.md5(_text(what.key_fields(), what.digits)), 1), WIDE - bits)


@dataclass(frozen=True)
class FrameSide:
    """A table that Spark reads; columns ``by`` that partition it also decide what is read of it."""

    frame: DataFrame

    def _within(self, what: Compared, within: Groups | None) -> DataFrame:
        rows = self.frame
        if within is None:
            return rows
        for name in what.by:
            found = within.frame.select(name).distinct().limit(MAX_PARTITION_LIST + 1).collect()
            if len(found) <= MAX_PARTITION_LIST:
                values = [r[0] for r in found if r[0] is not None]
                mine = F.col(f"`{name}`").isin(values)
                rows = rows.where(mine if len(values) == len(found) else mine | F.col(f"`{name}`").isNull())
        # A missing group is one like any other here.
        marks = {f"__{n}": F.coalesce(F.concat(F.lit("v"), F.col(f"`{n}`").cast("string")), F.lit("n")) for n in what.by}
        listed = KeyList.of(within.frame.withColumns(marks).withColumn("__bucket", F.col("bucket")), [*marks, "__bucket"])
        return listed.keep(rows.withColumns(marks | {"__bucket": bucket(what, within.bits)})).drop(*marks, "__bucket")

    def sums(self, what: Compared, bits: int, within: Groups | None = None) -> DataFrame:
        hashed = F.md5(_text(what.schema.fields, what.digits))
        rows = self._within(what, within).select(*what.by, bucket(what, bits).alias("bucket"), hashed.alias("__hash"))
        return rows.groupBy(*what.by, "bucket").agg(
            F.count(F.lit(1)).alias("n"), F.sum(_number(F.col("__hash"), 1)).alias("one"), F.sum(_number(F.col("__hash"), 9)).alias("two")
        )

    def rows(self, what: Compared, within: Groups) -> DataFrame:
        return self._within(what, within).select(*what.by, *what.schema.fieldNames())


# In a database ----------------------------------------------------------------


@dataclass(frozen=True)
class Dialect:
    """How a database spells what checksums need; ``{0}`` is the value."""

    md5: str = "MD5({0})"
    number: str = "CAST(CONV(SUBSTR({0}, {1}, 8), 16, 10) AS UNSIGNED)"
    text: str = "CAST({0} AS CHAR)"
    length: str = "CHAR_LENGTH({0})"
    timestamp: str = "DATE_FORMAT({0}, '%Y-%m-%d %H:%i:%s.%f')"
    binary: str = "HEX({0})"


MYSQL = Dialect()
SNOWFLAKE = Dialect(
    number="TO_NUMBER(SUBSTR({0}, {1}, 8), 'XXXXXXXX')",
    text="CAST({0} AS VARCHAR)",
    length="LENGTH({0})",
    timestamp="TO_CHAR({0}, 'YYYY-MM-DD HH24:MI:SS.FF6')",
    binary="HEX_ENCODE({0})",
)


@dataclass(frozen=True)
class ChecksumSql:
    """SQL text for checksums and rows of one table name of several tenants.

    The tenant is the only group. Each tenant is one branch of a query, with its own list of buckets.
    """

    table: str
    what: Compared
    dialect: Dialect = MYSQL
    quote: str = '"'

    def _text(self, fields: Sequence[T.StructField]) -> str:
        parts = []
        for field in fields:
            value, kind, d = quote_identifier(field.name, quote=self.quote), field.dataType, self.dialect
            if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
                if self.what.digits is None:
                    raise ValueError(f"{field.name}: how many digits of a fraction count?")
                text = d.text.format(f"CAST({value} AS DECIMAL(38, {self.what.digits}))")
            elif isinstance(kind, T.DecimalType):
                text = d.text.format(f"CAST({value} AS DECIMAL(38, {kind.scale}))")
            elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
                text = d.timestamp.format(value)
            elif isinstance(kind, T.BooleanType):
                text = f"CASE WHEN {value} THEN '1' ELSE '0' END"
            elif isinstance(kind, T.BinaryType):
                text = d.binary.format(value)
            else:
                text = d.text.format(value)
            size = d.text.format(d.length.format(text))
            parts.append(f"CASE WHEN {value} IS NULL THEN 'n' ELSE CONCAT('v', {size}, ':', {text}) END")
        return f"CONCAT({', '.join(parts)})" if len(parts) > 1 else parts[0]

    def _bucket(self, bits: int) -> str:
        if not bits:
            return "0"
        hashed = self.dialect.md5.format(self._text(self.what.key_fields()))
        return f"FLOOR({self.dialect.number.format(hashed, 1)} / {1 << (WIDE - bits)})"

    def _from(self, tenant: str, bits: int, buckets: Sequence[int] | None) -> str:
        name = quote_identifier(tenant, self.table, quote=self.quote)
        if buckets is None:
            return f"FROM {name}"
        return f"FROM {name} WHERE {self._bucket(bits)} IN ({', '.join(map(str, buckets))})"

    def sums(self, tenants: dict[str, Sequence[int] | None], bits: int, within_bits: int = 0) -> str:
        """Checksums of the buckets of each tenant, or of those within some buckets of the level before."""
        group = self.what.by[0]
        hashed = self.dialect.md5.format(self._text(self.what.schema.fields))
        one, two = (self.dialect.number.format("h", start) for start in (1, 9))
        parts = [
            f"SELECT {quote_literal(tenant)} AS {group}, bucket, COUNT(*) AS n, SUM({one}) AS one, SUM({two}) AS two "
            f"FROM (SELECT {self._bucket(bits)} AS bucket, {hashed} AS h {self._from(tenant, within_bits, buckets)}) hashed "
            "GROUP BY bucket"
            for tenant, buckets in tenants.items()
        ]
        return " UNION ALL ".join(parts)

    def rows(self, tenant: str, bits: int, buckets: Sequence[int] | None) -> str:
        """A tenant's rows in some buckets."""
        names = ", ".join(quote_identifier(n, quote=self.quote) for n in self.what.schema.fieldNames())
        return f"SELECT {quote_literal(tenant)} AS {self.what.by[0]}, {names} {self._from(tenant, bits, buckets)}"


@dataclass(frozen=True)
class DatabaseSide:
    """Tenants' tables of one name in a database, which works out the checksums itself.

    ``read`` runs a query (such as ``partial(read_query, spark, conn)``).
    """

    spark: SparkSession
    read: Callable[[str], DataFrame]
    table: str
    tenants: Sequence[str]
    dialect: Dialect = MYSQL
    quote: str = '"'
    #: Buckets a query lists of a tenant; beyond it the tenant is read whole.
    most_buckets: int = 2000

    def _wanted(self, what: Compared, within: Groups | None) -> Iterator[tuple[str, list[int] | None]]:
        if within is None:
            yield from ((tenant, None) for tenant in self.tenants)
            return
        first = F.slice(F.array_sort(F.collect_list("bucket")), 1, self.most_buckets + 1)
        # A row a tenant, each with a bounded list.
        for row in within.frame.groupBy(what.by[0]).agg(first.alias("buckets")).toLocalIterator():
            if row[0] in self.tenants:
                yield row[0], row["buckets"] if len(row["buckets"]) <= self.most_buckets else None

    def sums(self, what: Compared, bits: int, within: Groups | None = None) -> DataFrame:
        sql = ChecksumSql(self.table, what, self.dialect, self.quote)
        wanted, found = list(self._wanted(what, within)), []
        for at in range(0, len(wanted), TENANT_BATCH):
            query = sql.sums(dict(wanted[at : at + TENANT_BATCH]), bits, within.bits if within else 0)
            found.append(lower_columns(self.read(query)))
        schema = f"{what.by[0]} string, bucket long, n long, one long, two long"
        if not found:
            return empty_frame(self.spark, schema)
        sums = reduce(DataFrame.unionByName, found)
        # A tenant that was asked for whole has more buckets than are compared.
        whole = within is None or all(buckets is not None for _, buckets in wanted)
        sums = sums.select(*[F.col(f.name).cast(f.dataType) for f in T.StructType.fromDDL(schema).fields])
        return sums if whole else _inside(sums, what, bits, within)

    def rows(self, what: Compared, within: Groups) -> DataFrame:
        sql = ChecksumSql(self.table, what, self.dialect, self.quote)
        found = [lower_columns(self.read(sql.rows(t, within.bits, b))) for t, b in self._wanted(what, within)]
        kinds = [T.StructField(what.by[0], T.StringType()), *what.schema.fields]
        if not found:
            return empty_frame(self.spark, T.StructType(kinds))
        rows = reduce(DataFrame.unionByName, found).select(*[F.col(f"`{f.name.lower()}`").cast(f.dataType).alias(f.name) for f in kinds])
        return FrameSide(rows).rows(what, within)


def _inside(sums: DataFrame, what: Compared, bits: int, within: Groups) -> DataFrame:
    """Buckets that lie in those of the level before."""
    names = [*what.by, "__before"]
    marked = sums.withColumn("__before", F.shiftright("bucket", bits - within.bits))
    before = within.frame.withColumnRenamed("bucket", "__before")
    return KeyList.of(before, names).keep(marked).drop("__before").select(*what.by, "bucket", *SUMS)


# Both -------------------------------------------------------------------------


def differing(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """Buckets whose checksums are not the same on both sides; no bucket is joined with another."""
    sides = [
        side.select(*by, "bucket", *[(F.col(c).cast("long") * sign).alias(c) for c in SUMS])
        for side, sign in ((left, 1), (right, -1))
    ]
    total = sides[0].unionByName(sides[1]).groupBy(*by, "bucket").agg(*[F.sum(c).alias(c) for c in SUMS])
    return total.where(" or ".join(f"{c} <> 0" for c in SUMS)).select(*by, "bucket")


def differing_buckets(source: Side, target: Side, what: Compared, levels: Sequence[int] = LEVELS) -> Groups:
    """The buckets of the finest level that differ; each level is formed only within what differed before."""
    within = None
    for bits in levels:
        found = differing(source.sums(what, bits, within), target.sums(what, bits, within), what.by)
        within = Groups(reliable(found), bits)
        if within.frame.isEmpty():
            break
    return within


def reconcile_tree(source: Side, target: Side, what: Compared, levels: Sequence[int] = LEVELS) -> DataFrame:
    """What :func:`reconcile_rows` finds, reading by row only buckets that differ.

    Two buckets that are not the same go unnoticed with a chance of about
    2**-64. Where checksums count fewer digits than the values have, so do differences.
    """
    within = differing_buckets(source, target, what, levels)
    keys = [*what.by, *what.keys]
    return reconcile_rows(source.rows(what, within), target.rows(what, within), keys)
