import datetime

import pytest
from pyspark.sql import functions as F, types as T

from tableprep.errors import SchemaError
from tableprep.functions.fixed import MONEY_COMMENT
from tableprep.operators.imposed import (
    ImposedRules, KeyOffset, imposed_union, imposed_union_paths, lookup_schema, select_columns_ci,
)
from tests.test_reconcile import explained, rows, written

SCHEMA = (
    T.StructType().add("key", "string").add("amount", "double", True, {"comment": MONEY_COMMENT}).add("day", "date")
    .add("code", "string").add("n", "integer")
)
RULES = ImposedRules(
    key_offsets={"KEY": KeyOffset("person_id")}, null_codes={"Code": "9"}, required_key="key",
)


@pytest.fixture()
def instances(spark):
    full = spark.createDataFrame(
        [("1", 1.005, datetime.date(2020, 1, 2), None, "7"), ("", 2.0, None, "a", "8"), (None, 3.0, None, "b", "9"),
         ("x", 4.126, None, "c", "bad")],
        "key string, amount double, day date, code string, n string",
    )
    bare = spark.createDataFrame([("5",)], "Key string")
    return full, bare


def test_rules_and_blank_keys(instances):
    result = imposed_union(instances, "key, amount, day, code, n", SCHEMA, RULES)
    assert result.dtypes == [
        ("person_id", "bigint"), ("amount", "double"), ("day", "timestamp_ntz"), ("code", "string"), ("n", "int")
    ]
    assert rows(result) == sorted(
        [
            (100000000000001, 1.01, datetime.datetime(2020, 1, 2), "9", 7), (None, 4.13, None, "c", None),
            (100000000000005, None, None, "9", None),
        ],
        key=repr,
    )


def test_exact_money(instances):
    rules = ImposedRules(money_type=T.DecimalType(18, 2))
    result = imposed_union(instances[:1], ["amount"], SCHEMA, rules)
    assert sorted(str(r[0]) for r in result.collect()) == ["1.01", "2.00", "3.00", "4.13"]


def test_unknown_and_empty_columns(instances):
    with pytest.raises(SchemaError, match="nope"):
        imposed_union(instances, "key,nope", SCHEMA)
    with pytest.raises(SchemaError, match="empty"):
        imposed_union(instances, "key,,n", SCHEMA)


def test_absent_required_key(spark):
    with pytest.raises(SchemaError, match="key"):
        imposed_union([spark.range(1)], "n", SCHEMA, RULES)


def test_numeric_required_key(spark):
    numbers = spark.createDataFrame([(1,), (None,)], "key int")
    assert rows(imposed_union([numbers], "key", SCHEMA, RULES)) == [(100000000000001,)]


def test_blank_key_filter_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([("1", 2)], "key string, n int").write.parquet(f"{tmp_path}/t")
    plan = explained(imposed_union([spark.read.parquet(f"{tmp_path}/t")], "n", SCHEMA, RULES))
    assert "PushedFilters: [IsNotNull(key), Not(EqualTo(key,))]" in plan


def test_select_columns_ci(spark):
    a = spark.createDataFrame([(1, "x")], "Id int, Name string")
    b = spark.createDataFrame([(2,)], "ID bigint")
    result = select_columns_ci([a, b], " NAME , id, other")
    assert result.dtypes == [("NAME", "string"), ("id", "bigint"), ("other", "string")]
    assert rows(result) == [("x", 1, None), (None, 2, None)]


def test_lookup_schema(spark):
    registry = spark.createDataFrame(
        [("T", "D", 2, "b", "decimal(10,2)", None), ("T", "D", 1, "a", "int", "note"), ("T", "E", 1, "z", "int", None)],
        "table_name string, dataset string, ordinal int, column_name string, data_type string, comment string",
    )
    schema = lookup_schema(registry, "t", "d")
    assert schema.simpleString() == "struct<a:int,b:decimal(10,2)>"
    assert schema["a"].metadata == {"comment": "note"}
    with pytest.raises(SchemaError, match="missing"):
        lookup_schema(registry, "missing", "d")


def test_bad_values_become_null(spark):
    frame = spark.createDataFrame([("12",), ("12x",)], "n string")
    assert sorted(imposed_union([frame], "n", SCHEMA).toPandas()["n"].isna()) == [False, True]
    assert imposed_union([frame], "n", SCHEMA).agg(F.sum("n")).first()[0] == 12


def test_types_that_never_fit(spark):
    with pytest.raises(SchemaError, match="declared types"):
        imposed_union([spark.sql("select array(1) as n")], "n", SCHEMA)


def test_paths_ids_and_view(spark, instances):
    base = written(spark, {"y1": instances[0], "y2": instances[1], "y3": instances[0]})
    result = imposed_union_paths(spark, [base], "key,code", SCHEMA, RULES, "seqnum", 10**12, "imposed_view")
    assert spark.table("imposed_view").columns == ["seqnum", "person_id", "code"]
    assert result.count() == 5
    assert result.agg(F.count_distinct("seqnum")).first()[0] == 5 and result.agg(F.min("seqnum")).first()[0] == 10**12
    assert explained(result).split("\n\n\n")[0].count("Scan parquet") == 2  # two distinct schemas, three tables
    resolved = imposed_union_paths(spark, [base], "KEY, amount")
    assert resolved.dtypes == [("KEY", "string"), ("amount", "double")] and resolved.count() == 9
