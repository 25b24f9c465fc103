"""Schema reconciliation, one test per trap."""

import pytest
from pyspark.sql import functions as F

from tableprep.errors import EmptyInputError, ReadError, SchemaError
from tableprep.operators.reconcile import drift_report, observe, resolved_union, resolved_union_paths
from tableprep.sources.listing import discover_tables
from tableprep.storage import scratch_dir


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def explained(frame):
    return frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.fixture()
def drifted(spark):
    old = spark.createDataFrame([(1, 7, 1.5, 10)], "k int, c smallint, p float, code int")
    new = spark.createDataFrame([(2**40, 70000, 2.5, "x", "F")], "k bigint, c int, p double, code string, s string")
    return old, new


def test_types_order_and_nulls(drifted):
    result = resolved_union(drifted)
    assert result.dtypes == [("k", "bigint"), ("c", "int"), ("p", "double"), ("code", "string"), ("s", "string")]
    assert rows(result) == [(1, 7, 1.5, "10", None), (2**40, 70000, 2.5, "x", "F")]


def test_duplicates_are_kept(spark):
    same = spark.createDataFrame([(1,), (1,)], "k int")
    assert resolved_union([same, same]).count() == 4


def test_mixed_numbers_become_text_unless_asked(spark):
    a, b = spark.createDataFrame([(1,)], "v int"), spark.createDataFrame([(2.5,)], "v double")
    assert rows(resolved_union([a, b])) == [("1",), ("2.5",)]
    assert rows(resolved_union([a, b], mixed_numeric="double")) == [(1.0,), (2.5,)]


def test_defaults_come_after_the_first_table_and_vote(spark):
    a = spark.createDataFrame([(1, None)], "k int, n int")
    b = spark.createDataFrame([(2, 9)], "k int, extra int")
    result = resolved_union([a, b], {"n": "5", "q": "it's"})
    assert result.dtypes == [("k", "int"), ("n", "string"), ("q", "string"), ("extra", "int")]
    assert rows(result) == [(1, None, "it's", None), (2, "5", "it's", 9)]


def test_default_is_cast_to_the_resolved_type(spark):
    a, b = spark.createDataFrame([(1, 2**40)], "k int, n bigint"), spark.createDataFrame([(2,)], "k int")
    result = resolved_union([a, b], {"n": 5})
    assert dict(result.dtypes)["n"] == "bigint"
    assert rows(result) == [(1, 2**40), (2, 5)]


def test_names_match_whatever_their_case(spark):
    a, b = spark.createDataFrame([(1,)], "Amt int"), spark.createDataFrame([(2,)], "amt bigint")
    result = resolved_union([a, b])
    assert result.dtypes == [("Amt", "bigint")]
    assert rows(result) == [(1,), (2,)]


def test_rich_types_are_preserved(spark):
    rich = spark.sql(
        "select cast(1.25 as decimal(10,2)) as d, array(1) as a, named_struct('x', 1) as s, "
        "timestamp_ntz'2020-01-01 00:00:00' as t"
    )
    assert resolved_union([rich, rich]).schema.simpleString() == rich.schema.simpleString()


def test_nested_conflict_names_the_column(spark):
    a, b = spark.sql("select array(1) as list"), spark.sql("select array('x') as list")
    with pytest.raises(SchemaError, match="list"):
        resolved_union([a, b])


def test_odd_names(spark):
    a = spark.createDataFrame([(1, 2)], "`a.b` int, `c``d` int")
    assert rows(resolved_union([a, a])) == [(1, 2), (1, 2)]


def test_tag_is_a_literal_and_keeps_its_place(spark):
    a = spark.createDataFrame([("old", 1)], "src string, k int")
    b = spark.createDataFrame([(2,)], "k int")
    result = resolved_union([("x'y", a), ("2", b)], tag_column="src")
    assert result.columns == ["src", "k"]
    assert rows(result) == [("x'y", 1), ("2", 2)]


def test_no_tables():
    with pytest.raises(SchemaError):
        resolved_union([])


def test_drift_report(spark, drifted):
    report = drift_report(spark, observe([f.schema for f in drifted])).orderBy("ordinal").collect()
    assert [(r.column, r.resolved, r.observed, r.drifted) for r in report] == [
        ("k", "bigint", ["int", "bigint"], True), ("c", "int", ["smallint", "int"], True),
        ("p", "double", ["float", "double"], True), ("code", "string", ["int", "string"], True),
        ("s", "string", ["string"], False),
    ]


def written(spark, frames):
    base = scratch_dir(spark, "test")
    for name, frame in frames.items():
        frame.write.parquet(f"{base}/{name}")
    return base


def test_paths_with_equal_leaves_do_not_mix(spark):
    base = written(
        spark, {"a/2015": spark.createDataFrame([(1,)], "k int"), "b/2015": spark.createDataFrame([(2,)], "k int")}
    )
    result = resolved_union_paths(spark, [f"{base}/a", f"{base}/b"], tag_column="from", tag_pattern=r"/([ab])/2015/")
    assert rows(result) == [(1, "a"), (2, "b")]


def test_paths_with_odd_leaf_names(spark):
    one, other = spark.createDataFrame([(1,)], "k int"), spark.createDataFrame([(2,)], "k int")
    base = written(spark, {"a-b": one, "2016": other})
    assert rows(resolved_union_paths(spark, [base], tag_column="leaf")) == [(1, "a-b"), (2, "2016")]


def test_tags_of_paths_with_spaces_and_accents(spark):
    base = written(spark, {"jan 2016": spark.createDataFrame([(1,)], "k int"), "é%20+": spark.range(1).toDF("k")})
    assert rows(resolved_union_paths(spark, [base], tag_column="leaf")) == [(0, "é%20+"), (1, "jan 2016")]


def test_a_directory_of_files_is_one_table(spark):
    base = written(spark, {"one": spark.range(3)})
    assert discover_tables(spark, f"{base}/one") == [f"{base}/one"]
    assert resolved_union_paths(spark, [f"{base}/one"]).count() == 3


def test_empty_and_absent_directories(spark):
    base = scratch_dir(spark, "test")
    with pytest.raises(EmptyInputError, match=base):
        resolved_union_paths(spark, [base])
    with pytest.raises(ReadError):
        discover_tables(spark, base + "/none")


def test_widening_drift_is_one_scan(spark):
    base = written(
        spark,
        {
            "y1": spark.createDataFrame([(1, 1.5)], "k int, p float"),
            "y2": spark.createDataFrame([(2**40, 2.5, "x")], "k bigint, p double, s string"),
        },
    )
    result = resolved_union_paths(spark, [base], tag_column="year")
    plan = explained(result)
    assert plan.count("Scan parquet") == 2 and "Union" not in plan  # once in the tree, once in the details
    assert rows(result) == [(1, 1.5, None, "y1"), (2**40, 2.5, "x", "y2")]


def test_tables_of_equal_schema_share_a_scan(spark):
    one, other = spark.createDataFrame([(1,)], "k int"), spark.createDataFrame([("x",)], "k string")
    base = written(spark, {"a": one, "b": one, "c": other, "d": one, "e": other})
    result = resolved_union_paths(spark, [base])
    assert explained(result).split("\n\n\n")[0].count("Scan parquet") == 2
    assert rows(result) == [("1",), ("1",), ("1",), ("x",), ("x",)]


def test_default_absent_in_one_table_is_not_read_as_null(spark):
    base = written(
        spark, {"a": spark.createDataFrame([(1,)], "k int"), "b": spark.createDataFrame([(2, None)], "k int, n int")}
    )
    assert rows(resolved_union_paths(spark, [base], {"n": 7})) == [(1, 7), (2, None)]


def test_inner_partitions_keep_their_column(spark):
    base = scratch_dir(spark, "test")
    spark.createDataFrame([(1, "u"), (2, "v")], "k int, part string").write.partitionBy("part").parquet(f"{base}/t1")
    spark.createDataFrame([(3, "w")], "k bigint, part string").write.partitionBy("part").parquet(f"{base}/t2")
    assert rows(resolved_union_paths(spark, [base])) == [(1, "u"), (2, "v"), (3, "w")]


def test_filters_and_columns_reach_every_scan(spark):
    base = written(
        spark,
        {
            "a": spark.createDataFrame([(1, 10, "x")], "k int, code int, s string"),
            "b": spark.createDataFrame([(2, "y", "z")], "k bigint, code string, s string"),
        },
    )
    plan = explained(resolved_union_paths(spark, [base]).where(F.col("k") > 1).select("k"))
    details = [line for line in plan.splitlines() if line.startswith(("PushedFilters", "ReadSchema"))]
    assert len(details) == 4
    assert all("GreaterThan(k,1)" in line or line in ("ReadSchema: struct<k:int>", "ReadSchema: struct<k:bigint>")
               for line in details)


def test_a_filter_on_the_tag_skips_whole_files(spark):
    base = written(spark, {f"y{n}": spark.createDataFrame([(n,)], "k int") for n in range(1, 7)})
    united = resolved_union_paths(spark, [base], tag_column="leaf")
    one = united.where("leaf = 'y3'")
    assert rows(one) == [(3, "y3")]
    assert one.rdd.getNumPartitions() < united.rdd.getNumPartitions()


def test_many_frames(spark):
    frames = [spark.createDataFrame([(n,)], "k int" if n % 2 else "k bigint") for n in range(60)]
    assert rows(resolved_union(frames)) == sorted([(n,) for n in range(60)], key=repr)


def test_view_is_registered(spark):
    base = written(spark, {"a": spark.range(2)})
    resolved_union_paths(spark, [base], view_name="united")
    assert spark.table("united").count() == 2


def test_filters_beyond_the_narrow_type_keep_its_rows(spark):
    """One scan reads int and bigint files; a bound that overflows int must not skip the int files."""
    base = written(
        spark,
        {
            "a": spark.createDataFrame([(2_000_000_000, 0.1)], "k int, p float"),
            "b": spark.createDataFrame([(6_000_000_000, 0.1)], "k bigint, p double"),
        },
    )
    united = resolved_union_paths(spark, [base])
    assert united.where("k < 5000000000").count() == 1
    assert united.where("k > -5000000000").count() == 2
    assert united.where("k in (2000000000, 6000000000)").count() == 2
    assert united.where("k = 2000000000 - 4294967296").count() == 0
    assert united.where("p > 0.1").count() == 1 and united.where("p >= 0.1").count() == 2
