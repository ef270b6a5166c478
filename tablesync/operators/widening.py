"""One type for a column that has several: the narrowest that holds all their values exactly."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import types as T

#: Whole numbers from the narrowest on, and the digits each may have.
WHOLE = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 19}
#: Whole digits that a double, or a float, holds exactly.
EXACT = {T.FloatType(): 7, T.DoubleType(): 15}
TIMES = [T.DateType(), T.TimestampNTZType()]
MOST_DIGITS = 38


def _digits(kind: T.DataType) -> tuple[int, int] | None:
    """Digits before and after the point of an exact number."""
    if isinstance(kind, T.DecimalType):
        return kind.precision - kind.scale, kind.scale
    return (WHOLE[kind], 0) if kind in WHOLE else None


def wider(one: T.DataType, two: T.DataType) -> T.DataType:
    """The least type above both; text is above all.

    Whole numbers and decimals become decimals of enough digits. A double takes in what it
    holds exactly: floats, and whole numbers of up to 15 digits. A date becomes a time
    without zone. Others that differ have only their text in common.
    """
    if one == two:
        return one
    if isinstance(one, T.NullType) or isinstance(two, T.NullType):
        return two if isinstance(one, T.NullType) else one
    if one in WHOLE and two in WHOLE:
        return max(one, two, key=WHOLE.__getitem__)
    a, b = _digits(one), _digits(two)
    if a and b:
        before, after = max(a[0], b[0]), max(a[1], b[1])
        return T.DecimalType(before + after, after) if before + after <= MOST_DIGITS else T.StringType()
    if one in EXACT and two in EXACT:
        return T.DoubleType()
    for real, other in ((one, b), (two, a)):
        if real in EXACT and other and not other[1] and other[0] <= EXACT[T.DoubleType()]:
            return real if other[0] <= EXACT[real] else T.DoubleType()
    if one in TIMES and two in TIMES:
        return TIMES[1]
    return T.StringType()


def wider_type(kinds: Iterable[T.DataType]) -> T.DataType:
    """The least type above all of ``kinds``, in whatever order they come."""
    found = set(kinds)
    # Exact numbers first: what they come to decides whether a double can hold them.
    exact = reduce(wider, (k for k in found if _digits(k)), T.NullType())
    return reduce(wider, sorted((k for k in found if not _digits(k)), key=str), exact)


def wider_schema(*schemas: T.StructType) -> T.StructType:
    """All columns of several schemas, matched without case, each of its wider type."""
    kinds: dict[str, list[T.DataType]] = {}
    names: dict[str, str] = {}
    for field in (f for schema in schemas for f in schema.fields):
        names.setdefault(field.name.lower(), field.name)
        kinds.setdefault(field.name.lower(), []).append(field.dataType)
    return T.StructType([T.StructField(names[n], wider_type(found)) for n, found in kinds.items()])
