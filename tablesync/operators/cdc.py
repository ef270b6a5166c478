"""Reducing changes to the newest per key, and applying them to a table."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

DELETE_CODE = "D"
DELETED = "deleted"


def _c(name: str, side: str | None = None) -> Column:
    return F.col(f"{side}.`{name}`" if side else f"`{name}`")


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, (T.MapType, T.VariantType)):
        return False
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_orderable(field.dataType) for field in kind.fields)
    return True


def align(df: DataFrame, schema: T.StructType, ignored: Iterable[str] | None = None) -> DataFrame:
    """Cast ``df`` to the columns of ``schema``, matched without case.

    A column ``df`` lacks becomes null. A column the schema lacks raises, unless
    ``ignored`` names it: a new column of the source must not vanish unseen.
    """
    present = {name.lower(): name for name in df.columns}
    known = {field.name.lower() for field in schema.fields} | {n.lower() for n in ignored or ()}
    if unknown := sorted(set(present) - known):
        raise ValueError(f"columns the target does not declare: {', '.join(unknown)}")
    columns = []
    for field in schema.fields:
        name = present.get(field.name.lower())
        value = F.lit(None) if name is None else _c(name)
        columns.append(value.cast(field.dataType).alias(field.name))
    return df.select(columns)


def latest_change(changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one that is last by ``order``.

    A grouped maximum, not a window: each task keeps one row per key before
    the shuffle, so a key with very many changes stays cheap. Equal order is
    broken by the other columns in order of their names, here and in
    :func:`choose_newer`, so the result does not depend on how the input is split.
    """
    if not keys or not order:
        raise ValueError("the newest change is found by keys and order columns")
    rest = sorted(name for name in changes.columns if name not in set(keys) | set(order))
    kinds = {field.name: field.dataType for field in changes.schema.fields}
    ranked = [*order, *[name for name in rest if _orderable(kinds[name])]]
    row = F.struct(*[_c(name) for name in ranked])
    if len(ranked) == len(order) + len(rest):
        newest = F.max(row)
    else:
        newest = F.max_by(F.struct(*[_c(name) for name in [*order, *rest]]), row)
    grouped = changes.groupBy(*[_c(name) for name in keys]).agg(newest.alias("__row"))
    return grouped.select(
        [_c(n) if n in keys else F.col(f"__row.`{n}`").alias(n) for n in changes.columns]
    )


def same_key(keys: Iterable[str], left: str, right: str) -> Column:
    """Equality of the key columns of two aliased frames."""
    return reduce(Column.__and__, [_c(k, left) == _c(k, right) for k in keys])


def choose_newer(
    joined: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str],
    order: Sequence[str],
    ordered_target: bool,
    ties: Sequence[str] = (),
    kept: Sequence[str] = (),
) -> DataFrame:
    """Take each row's values from ``t`` or from the change ``c``, whichever is newer.

    ``joined`` is a join of frames aliased ``t`` and ``c``; ``c`` carries the
    marker ``__change``. A target row without order values is older than any
    change. Equal order is broken by the columns ``ties``, as among changes, so
    neither the split of the changes nor a repetition alters anything. Columns
    ``kept`` are not in the change and keep the value of ``t``.
    """
    wins = _c("__change", "c").isNotNull()
    if ordered_target:
        ranked = [*order, *ties]
        newer = F.struct(*[_c(o, "c") for o in ranked]) >= F.struct(*[_c(o, "t") for o in ranked])
        wins = wins & newer
    values = []
    for name in columns:
        if name in keys:
            value = F.coalesce(_c(name, "t"), _c(name, "c"))
        elif name in kept:
            value = _c(name, "t")
        else:
            value = F.when(F.col("__wins"), _c(name, "c")).otherwise(_c(name, "t"))
        values.append(value.alias(name))
    # Compared once per row, however many columns there are.
    return joined.withColumn("__wins", wins).select(values)


def with_deleted(changes: DataFrame, op_col: str | None, delete_code: str = DELETE_CODE) -> DataFrame:
    """Turn the operation column into the flag ``deleted``; without one, nothing is deleted."""
    if op_col is None:
        return changes.withColumn(DELETED, F.lit(False))
    flag = F.coalesce(_c(op_col) == F.lit(delete_code), F.lit(False))
    return changes.withColumn(DELETED, flag).drop(op_col)


def tie_columns(
    changes: T.StructType, target: T.StructType, keys: Iterable[str], order: Iterable[str]
) -> list[str]:
    """Columns that break ties between a change and a row: those of both that have an order, by name."""
    mine = {f.name for f in changes.fields if _orderable(f.dataType)}
    theirs = {f.name for f in target.fields if _orderable(f.dataType)}
    return sorted(mine & theirs - set(keys) - set(order))


def apply_changes(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    op_col: str | None = None,
    delete_code: str = DELETE_CODE,
) -> DataFrame:
    """The target after all ``changes``: upserts by key, deletes by ``op_col``.

    ``target`` holds one row per key. Columns that the changes lack keep their
    values. If it carries the order columns, an older change does not overwrite
    a newer row. If it carries the flag ``deleted``,
    deleted rows stay as tombstones; otherwise they are left out. Changes are
    reduced before the join, so no key meets more than one change.
    """
    ordered = set(order) <= set(target.columns)
    tombstones = DELETED in target.columns
    newest = latest_change(with_deleted(changes, op_col, delete_code), keys, order)
    base = target if tombstones else target.withColumn(DELETED, F.lit(False))
    ties = tie_columns(newest.schema, base.schema, keys, order)
    kept = [name for name in base.columns if name not in newest.columns]
    change = newest.withColumn("__change", F.lit(True))
    joined = base.alias("t").join(change.alias("c"), same_key(keys, "t", "c"), "full_outer")
    result = choose_newer(joined, base.columns, keys, order, ordered, ties, kept)
    return result if tombstones else result.where(~F.col(DELETED)).drop(DELETED)
