"""The type lattice: which single type holds every type seen for one column."""

from __future__ import annotations

import datetime
import decimal
import re
from collections.abc import Iterable

from pyspark.sql import types as T

from tableprep.errors import SchemaError

INTEGERS = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
REALS = (T.FloatType(), T.DoubleType())
NESTED = (T.ArrayType, T.MapType, T.StructType)
ATOMIC = (
    T.BinaryType, T.BooleanType, T.ByteType, T.CalendarIntervalType, T.DateType, T.DoubleType, T.FloatType,
    T.IntegerType, T.LongType, T.NullType, T.ShortType, T.StringType, T.TimestampType,
)


def distinct_types(types: Iterable[T.DataType]) -> list[T.DataType]:
    """Types in first-seen order. Nullability inside nested types does not make two types different."""
    seen: dict[str, T.DataType] = {}
    for data_type in types:
        seen.setdefault(data_type.simpleString(), data_type)
    return list(seen.values())


def resolve_type(types: Iterable[T.DataType], mixed_numeric: str = "string") -> T.DataType:
    """One type for a column.

    Unanimous types stay; any string makes it string; all-integer and all-real columns widen; every other mix is a
    string. ``mixed_numeric="double"`` widens integer-with-real mixes to double instead.
    """
    seen = distinct_types(types)
    if len(seen) == 1:
        return seen[0]
    nested = [t.simpleString() for t in seen if isinstance(t, NESTED)]
    if nested:
        raise SchemaError(f"nested types conflict: {', '.join(t.simpleString() for t in seen)}")
    for ladder in (INTEGERS, REALS):
        if all(t in ladder for t in seen):
            return ladder[max(ladder.index(t) for t in seen)]
    if mixed_numeric == "double" and all(t in INTEGERS or t in REALS for t in seen):
        return T.DoubleType()
    return T.StringType()


def type_of_text(value: str) -> T.DataType:
    """The type of a value written as text: a number or date only if it would be written that way again, so ``01`` and
    ``1e3`` are text."""
    if re.fullmatch("0|-?[1-9][0-9]*", value) and -(2**63) <= int(value) < 2**63:
        return T.IntegerType() if -(2**31) <= int(value) < 2**31 else T.LongType()
    if re.fullmatch(r"-?[0-9]+\.[0-9]+", value) and repr(float(value)) == value:
        return T.DoubleType()
    if re.fullmatch("[0-9]{4}-[0-9]{2}-[0-9]{2}", value):
        try:
            datetime.date.fromisoformat(value)
        except ValueError:
            return T.StringType()
        return T.DateType()
    return T.StringType()


def reader_widens(observed: T.DataType, resolved: T.DataType) -> bool:
    """Whether the Parquet reader itself can return ``observed`` file data as ``resolved``."""
    return observed.simpleString() == resolved.simpleString() or any(
        observed in ladder and resolved in ladder and ladder.index(observed) <= ladder.index(resolved)
        for ladder in (INTEGERS, REALS)
    )


def type_of_default(value: object) -> T.DataType:
    """The type a default value votes for."""
    if isinstance(value, bool):
        return T.BooleanType()
    if isinstance(value, int):
        return T.IntegerType() if -(2**31) <= value < 2**31 else T.LongType()
    if isinstance(value, decimal.Decimal):
        digits = value.as_tuple()
        scale = max(0, -digits.exponent)
        return T.DecimalType(max(len(digits.digits), scale), scale)
    for kind, spark_type in (
        (float, T.DoubleType()), (str, T.StringType()), (bytes, T.BinaryType()),
        (datetime.datetime, T.TimestampNTZType()), (datetime.date, T.DateType()),
    ):
        if isinstance(value, kind):
            return spark_type
    raise SchemaError(f"no column type for default {value!r}")
