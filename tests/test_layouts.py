"""Tables whose directories are named after values, alone and beside others."""

import pytest
from pyspark.sql import functions as F, types as T

from tableprep import discover_tables, imposed_union_paths, resolved_union_paths, strip_common_prefix, stripped_prefix
from tableprep.errors import SchemaError, WriteError
from tableprep.functions.types import type_of_text
from tableprep.operators.reconcile import open_instances
from tableprep.storage import list_children, rename, scratch_dir
from tests.test_plans import explained


def loose_file(spark, frame, base, name):
    frame.coalesce(1).write.parquet(f"{base}/../loose-{name}")
    part = next(e for e in list_children(spark, f"{base}/../loose-{name}") if not e.is_dir)
    rename(spark, part.path, f"{base}/{name}")


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_values_in_directory_names_become_a_column(spark):
    base = scratch_dir(spark, "test") + "/t"
    for y in (0, 1):
        spark.range(y, y + 1).write.parquet(f"{base}/y={y}")
    assert discover_tables(spark, base) == [base]
    assert rows(resolved_union_paths(spark, [base])) == [(0, 0), (1, 1)]
    assert resolved_union_paths(spark, [base]).schema["y"].dataType == T.IntegerType()
    plan = explained(resolved_union_paths(spark, [base]).where("y = 1"))
    assert "PartitionFilters: [isnotnull(y" in plan


def test_files_of_any_name_count(spark):
    base = scratch_dir(spark, "test") + "/t"
    spark.range(5).write.parquet(f"{base}/a")
    loose_file(spark, spark.range(5, 6), base, "000000_0")
    assert len(discover_tables(spark, base)) == 2
    assert rows(resolved_union_paths(spark, [base])) == [(i,) for i in range(6)]


def test_different_layouts_meet(spark):
    base = scratch_dir(spark, "test") + "/t"
    month = F.lpad((F.col("id") % 3 + 1).cast("string"), 2, "0")
    spark.range(6).select("id", month.alias("m"), F.when(F.col("id") < 5, F.lit("a b/c")).alias("p")).write.partitionBy("p", "m").parquet(f"{base}/old")
    spark.range(6, 8).select(F.col("id").cast("int"), F.lit(4).alias("m")).write.parquet(f"{base}/new")
    spark.range(8, 10).select("id", F.lit(2**40).alias("m")).write.partitionBy("m").parquet(f"{base}/last")
    loose_file(spark, spark.range(10, 11), base, "odd name")
    found = resolved_union_paths(spark, [base], tag_column="from", tag_pattern="/t/([^/]+)")
    assert [(f.name, f.dataType.simpleString()) for f in found.schema] == [("id", "bigint"), ("m", "string"), ("p", "string"), ("from", "string")]
    want = [(i, f"0{i % 3 + 1}", "a b/c" if i < 5 else None, "old") for i in range(6)] + [(i, "4", None, "new") for i in (6, 7)]
    want += [(i, str(2**40), None, "last") for i in (8, 9)] + [(10, None, None, "odd name")]
    assert rows(found) == sorted(want, key=repr)
    assert rows(imposed_union_paths(spark, [base], "id, m")) == sorted(((w[0], w[1]) for w in want), key=repr)


def test_partitions_beside_other_tables(spark):
    base = scratch_dir(spark, "test") + "/t"
    spark.range(2).select("id", F.col("id").alias("y")).write.partitionBy("y").parquet(base)
    spark.range(2, 3).select("id", F.lit(7).alias("y")).write.parquet(f"{base}/flat")
    spark.range(3, 4).select("id", F.lit("x").alias("z")).write.parquet(f"{base}/z=x")
    assert [path.rsplit("/", 1)[-1] for path in discover_tables(spark, base)] == ["flat", "y=*", "z=*"]
    assert rows(resolved_union_paths(spark, [base]).select("id", "y")) == [(0, 0), (1, 1), (2, 7), (3, None)]


def test_a_column_in_files_and_names(spark):
    base = scratch_dir(spark, "test") + "/t"
    spark.range(2).select("id", F.lit(5).alias("Y")).write.parquet(f"{base}/y=6")
    assert rows(resolved_union_paths(spark, [base])) == [(0, 6), (1, 6)]


def test_layouts_that_contradict_themselves(spark):
    base = scratch_dir(spark, "test") + "/t"
    spark.range(1).write.parquet(f"{base}/y=1/a=1")
    spark.range(1).write.parquet(f"{base}/y=2/b=1")
    with pytest.raises(SchemaError):
        open_instances(spark, [base])


def test_types_of_values():
    assert {v: type_of_text(v).simpleString() for v in ("0", "-5", "05", "-0", str(2**31), str(2**63), "1.5", "1.50", "1e3", "", "2020-02-29", "2021-02-29")} == {
        "0": "int", "-5": "int", "05": "string", "-0": "string", str(2**31): "bigint", str(2**63): "string", "1.5": "double",
        "1.50": "string", "1e3": "string", "": "string", "2020-02-29": "date", "2021-02-29": "string"}


def test_unions_numbered_anew_and_stored(spark):
    base = scratch_dir(spark, "test")
    spark.range(3).select("id", F.lit(9).alias("n")).write.parquet(f"{base}/raw/t/a")
    spark.range(3, 5).select("id", F.lit(9).alias("n")).write.parquet(f"{base}/raw/t/b")
    assert rows(resolved_union_paths(spark, [f"{base}/raw/t"], numbered=("n", ["id"]))) == [(i, i + 1) for i in range(5)]
    stored = imposed_union_paths(spark, [f"{base}/raw/t"], "id", stored_for=f"{base}/raw/t", view_name="stored_t")
    assert rows(stored) == [(i,) for i in range(5)] == rows(spark.table("stored_t"))
    assert all(e.name.endswith(".gz.parquet") for e in list_children(spark, f"{base}/intermediate/t_nppk"))
    with pytest.raises(WriteError):
        imposed_union_paths(spark, [f"{base}/raw/t"], "id", stored_for=f"{base}/raw/t")


def test_what_was_stripped(spark):
    dotted = spark.range(1).select(F.lit(1).alias("t.a"), F.lit(2).alias("t.b"))
    assert (stripped_prefix(dotted), strip_common_prefix(dotted).columns) == ("t.", ["a", "b"])
    assert (stripped_prefix(spark.range(1)), stripped_prefix(dotted.withColumn("t.", F.lit(1)))) == ("", "")
