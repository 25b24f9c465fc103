"""Cases that used to lose, swap or change data."""

import pytest
from pyspark.sql import functions as F

from tableprep import (
    char_histogram, compact, discover_tables, overlay_tables, read_header_csv, resolved_union_paths, safe_column_names,
    sql_file_job, sql_query, strip_common_prefix, write_range_named,
)
from tableprep.errors import ReadError, WriteError
from tableprep.sources.listing import file_catalog
from tableprep.storage import hadoop_path, list_children, rename, scratch_dir


def test_compaction_takes_files_of_any_name_and_depth(spark):
    base = scratch_dir(spark, "test")
    spark.range(10).coalesce(1).write.parquet(f"{base}/in")
    spark.range(10, 20).coalesce(1).write.parquet(f"{base}/in/nested")
    part = next(e for e in list_children(spark, f"{base}/in") if e.name.startswith("part"))
    rename(spark, part.path, f"{base}/in/000000_0")
    compact(spark, f"{base}/in", f"{base}/out")
    assert spark.read.parquet(f"{base}/out").count() == 20


def test_compaction_keeps_partition_values_as_written(spark):
    base = scratch_dir(spark, "test")
    spark.range(40).select("id", F.lpad((F.col("id") % 2).cast("string"), 2, "0").alias("p")).write.partitionBy("p").parquet(f"{base}/in")
    with pytest.raises(WriteError):
        compact(spark, f"{base}/in", f"{base}/no")
    compact(spark, f"{base}/in", f"{base}/out", by=["p"])
    assert {e.name for e in list_children(spark, f"{base}/out")} == {"p=00", "p=01"}
    assert spark.read.parquet(f"{base}/out").count() == 40


def test_stray_files_and_directories_are_all_tables(spark):
    base = scratch_dir(spark, "test")
    for name, n in (("1995", 2), ("1996", 2), ("loose", 1)):
        spark.range(n).coalesce(1).write.parquet(f"{base}/t/{name}")
    part = next(e for e in list_children(spark, f"{base}/t/loose") if e.name.startswith("part"))
    rename(spark, part.path, f"{base}/t/extra.parquet")
    fs, path = hadoop_path(spark, f"{base}/t/loose")
    fs.delete(path, True)
    assert len(discover_tables(spark, f"{base}/t")) == 3
    assert resolved_union_paths(spark, [f"{base}/t"]).count() == 5


def test_spelling_in_a_case_sensitive_session(spark):
    base = scratch_dir(spark, "test")
    spark.range(2).select(F.col("id").cast("int").alias("Amt")).write.parquet(f"{base}/t/a")
    spark.range(2).select(F.col("id").alias("amt")).write.parquet(f"{base}/t/b")
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        union = resolved_union_paths(spark, [f"{base}/t"])
        assert sorted(row[0] for row in union.collect()) == [0, 0, 1, 1]
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_headers_in_another_order_are_an_error(spark):
    base = scratch_dir(spark, "test")
    spark.createDataFrame([("x", "y")], "a string, b string").coalesce(1).write.csv(f"{base}/one", header=True)
    spark.createDataFrame([("y", "x")], "b string, a string").coalesce(1).write.csv(f"{base}/two", header=True)
    with pytest.raises(Exception, match="header|Header"):
        read_header_csv(spark, f"{base}/one", f"{base}/two").collect()


def test_malformed_text_is_profiled(spark):
    frame = spark.range(1).select(F.expr("cast(X'FF41' as string)").alias("t"))
    assert {r.bucket: r.n for r in char_histogram(frame, "t").collect()} == {65: 1, 256: 1}


def test_overlay_of_drifting_types(spark):
    top = spark.createDataFrame([(1, 5)], "k int, v int")
    below = spark.createDataFrame([("1", "x"), ("2", "y")], "k string, v string")
    assert sorted(map(tuple, overlay_tables([top, below], ["k"]).collect())) == [("1", "5"), ("2", "y")]


def test_append_is_refused_before_anything_is_written(spark):
    base = scratch_dir(spark, "test")
    write_range_named(spark.range(3), f"{base}/t")
    with pytest.raises(WriteError):
        write_range_named(spark.range(3), f"{base}/t", mode="append")
    assert spark.read.parquet(f"{base}/t").count() == 3


def test_catalogs_hold_direct_files_only(spark):
    base = scratch_dir(spark, "test")
    spark.range(4).withColumn("p", F.col("id")).write.partitionBy("p").parquet(f"{base}/t")
    assert file_catalog(spark, f"{base}/t", "*.parquet").count() == 0
    spark.range(4).coalesce(1).write.parquet(f"{base}/flat")
    assert file_catalog(spark, f"{base}/flat", "*.parquet").count() == 1


def test_jobs_leave_views_alone_and_name_their_file(spark):
    base = scratch_dir(spark, "test")
    spark.range(1).createOrReplaceTempView("mine")
    assert sql_query(spark, "select count(*) from mine", {"mine": spark.range(7)}).first()[0] == 7
    assert spark.table("mine").count() == 1
    spark.createDataFrame([("select 1",), ("select 2",)], "value string").repartition(2).write.text(f"{base}/sql")
    with pytest.raises(ReadError):
        sql_file_job(spark, f"{base}/sql")


def test_names_stay_distinct_and_not_empty(spark):
    assert safe_column_names(spark.createDataFrame([(1, 2)], "`select` int, select_ int")).columns == ["select__", "select_"]
    assert strip_common_prefix(spark.createDataFrame([(1, 2)], "`t.` int, `t.a` int")).columns == ["t.", "t.a"]
