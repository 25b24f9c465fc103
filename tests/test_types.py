"""The type lattice as a join semilattice with string on top."""

import datetime
import decimal
from functools import reduce

import pytest
from hypothesis import given, strategies as st
from pyspark.sql import types as T

from tableprep.errors import SchemaError
from tableprep.functions.types import reader_widens, resolve_type, type_of_default

KINDS = [
    T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.StringType(),
    T.DateType(), T.TimestampType(), T.TimestampNTZType(), T.BooleanType(), T.BinaryType(), T.DecimalType(10, 2),
]
kinds = st.sampled_from(KINDS)
modes = st.sampled_from(["string", "double"])


@given(kinds, kinds, modes)
def test_commutative(a, b, mode):
    assert resolve_type([a, b], mode) == resolve_type([b, a], mode)


@given(kinds, modes)
def test_idempotent(a, mode):
    assert resolve_type([a, a], mode) == a


@given(kinds, modes)
def test_string_absorbs(a, mode):
    assert resolve_type([a, T.StringType()], mode) == T.StringType()


@given(st.lists(kinds, min_size=1, max_size=6), modes)
def test_folding_pairwise_equals_folding_the_set(types, mode):
    assert reduce(lambda a, b: resolve_type([a, b], mode), types) == resolve_type(types, mode)


def test_mixes():
    assert resolve_type([T.ByteType(), T.LongType(), T.ShortType()]) == T.LongType()
    assert resolve_type([T.FloatType(), T.DoubleType()]) == T.DoubleType()
    assert resolve_type([T.IntegerType(), T.DoubleType()]) == T.StringType()
    assert resolve_type([T.IntegerType(), T.DoubleType()], "double") == T.DoubleType()
    assert resolve_type([T.DateType(), T.TimestampType()]) == T.StringType()


def test_unanimous_types_survive():
    for kind in (T.DecimalType(10, 2), T.ArrayType(T.IntegerType()), T.TimestampNTZType()):
        assert resolve_type([kind, kind]) == kind
    lax, strict = T.ArrayType(T.IntegerType(), True), T.ArrayType(T.IntegerType(), False)
    assert resolve_type([lax, strict]) == lax


def test_nested_conflict_is_an_error():
    with pytest.raises(SchemaError):
        resolve_type([T.ArrayType(T.IntegerType()), T.ArrayType(T.StringType())])


def test_reader_widening():
    assert reader_widens(T.IntegerType(), T.LongType())
    assert not reader_widens(T.LongType(), T.IntegerType())
    assert not reader_widens(T.IntegerType(), T.StringType())
    assert not reader_widens(T.IntegerType(), T.DoubleType())


@pytest.mark.parametrize(
    "value, kind",
    [
        (True, T.BooleanType()), (5, T.IntegerType()), (2**40, T.LongType()), (1.5, T.DoubleType()),
        ("x", T.StringType()), (decimal.Decimal("1.25"), T.DecimalType(3, 2)),
        (datetime.date(2020, 1, 1), T.DateType()), (datetime.datetime(2020, 1, 1), T.TimestampNTZType()),
    ],
)
def test_default_types(value, kind):
    assert type_of_default(value) == kind


def test_default_without_a_type():
    with pytest.raises(SchemaError):
        type_of_default(object())
