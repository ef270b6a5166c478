"""Names of tenants, tables and columns as column expressions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def same_name(column: Column | str) -> Column:
    """The form in which two names are compared: case does not count."""
    return F.upper(_col(column))


def qualified(schema: Column | str, table: Column | str) -> Column:
    """``schema.table``, for display and for file names; joins use two columns."""
    return F.concat_ws(".", _col(schema), _col(table))


def quoted(*parts: Column | str) -> Column:
    """``"A"."B"``: the parts as a quoted identifier, upper-cased."""
    pattern = ".".join(['"%s"'] * len(parts))
    return F.format_string(pattern, *[F.upper(_col(p)) for p in parts])


def quote_identifier(*parts: str, quote: str = '"') -> str:
    """The parts as a quoted identifier for SQL text; a quote inside is doubled."""
    return ".".join(quote + part.replace(quote, quote * 2) + quote for part in parts)


def quote_literal(value: str) -> str:
    """A string literal for SQL text."""
    return "'" + value.replace("'", "''") + "'"


def schema_part(name: Column | str) -> Column:
    """The tenant of a qualified ``schema.table`` name."""
    return F.split_part(_col(name), F.lit("."), F.lit(1))


def table_part(name: Column | str) -> Column:
    """The table of a qualified name; dots after the first belong to it."""
    name = _col(name)
    return F.substring(name, F.instr(name, ".") + 1, F.length(name))


def path_part(path: Column | str, position: int) -> Column:
    """The ``position``-th part of a path, counted from 1."""
    return F.split_part(_col(path), F.lit("/"), F.lit(position))


def lower_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name."""
    return df.toDF(*[name.lower() for name in df.columns])


def lower_values(df: DataFrame) -> DataFrame:
    """Lower-case every value of every column."""
    return df.select([F.lower(F.col(f"`{name}`")).alias(name) for name in df.columns])


def stamped(df: DataFrame, name: str, run_ts: datetime | Column | None = None) -> DataFrame:
    """Add the run time: the given one, or the time the query starts."""
    if run_ts is None:
        value = F.current_timestamp()
    else:
        value = run_ts if isinstance(run_ts, Column) else F.lit(run_ts)
    return df.withColumn(name, value)


def timestamp_text(column: Column | str) -> Column:
    """A timestamp as ``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(_col(column), "yyyy-MM-dd HH:mm:ss")
