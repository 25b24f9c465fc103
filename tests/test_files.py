"""Sources and sinks."""

import pytest
from pyspark.sql import functions as F

from tableprep.errors import EmptyInputError, ReadError, SqlError, WriteError
from tableprep.plans.sqljobs import sql_file_job, sql_query
from tableprep.sinks import writers
from tableprep.sinks.range_named import range_name, rename_parts, write_range_named
from tableprep.sources import listing, readers
from tableprep.storage import list_children, part_order, scratch_dir
from tests.test_reconcile import rows


def text_file(tmp_path, name, body):
    (tmp_path / name).write_bytes(body.encode())
    return str(tmp_path / name)


@pytest.mark.parametrize("fmt", ["parquet", "orc", "csv", "text"])
def test_round_trip(spark, fmt):
    frame = spark.createDataFrame([("a",), ("é €",)], "value string")
    path = scratch_dir(spark, "test") + "/t"
    getattr(writers, f"write_{fmt}")(frame, path)
    assert rows(getattr(readers, f"read_{fmt}")(spark, path).toDF("value")) == [("a",), ("é €",)]
    with pytest.raises(WriteError) as error:
        getattr(writers, f"write_{fmt}")(frame, path, code=77)
    assert error.value.code == 77
    getattr(writers, f"write_{fmt}")(frame, path, mode="overwrite")


@pytest.mark.parametrize("fmt", ["parquet", "orc", "csv", "text"])
def test_missing_input(spark, fmt):
    with pytest.raises(ReadError) as error:
        getattr(readers, f"read_{fmt}")(spark, "/nowhere/at/all", code=5)
    assert error.value.code == 5


def test_csv_defaults(spark, tmp_path):
    assert readers.read_csv(spark, text_file(tmp_path, "a.csv", "1,x\n2,y\n")).dtypes == [
        ("_c0", "string"), ("_c1", "string")
    ]


def test_header_csv_drops_only_a_blank_last_row(spark, tmp_path):
    one = text_file(tmp_path, "one.csv", 'k,v\n1,"two\nlines"\n,\n2,"say ""hi"""\n,\n')
    two = text_file(tmp_path, "two.csv", "k,v\n,\n,\n")
    three = text_file(tmp_path, "three.csv", "k,v\n3,c\n")
    assert rows(readers.read_header_csv(spark, one)) == sorted(
        [("1", "two\nlines"), (None, None), ("2", 'say "hi"')], key=repr
    )
    assert rows(readers.read_header_csv(spark, two)) == [(None, None)]
    assert readers.read_header_csv(spark, one, two, three).count() == 5
    assert readers.read_header_csv(spark, one, two, three).columns == ["k", "v"]


def test_header_csv_across_batches(spark, tmp_path):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        path = text_file(tmp_path, "a.csv", "1,x\n,\n2,y\n,\n,\n")
        assert readers.read_header_csv(spark, path, header=False).count() == 4
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_lines(spark, tmp_path):
    path = text_file(tmp_path, "three.txt", "a\nb\nc\n")
    assert rows(readers.read_lines(spark, path)) == [("a",), ("b",), ("c",)]
    with pytest.raises(EmptyInputError) as error:
        readers.read_lines(spark, text_file(tmp_path, "empty.txt", ""))
    assert error.value.code == 304


def test_numbered_lines_of_split_files(spark, tmp_path):
    paths = [text_file(tmp_path, f"{n}.txt", "".join(f"{n} {i}\n" for i in range(1, 401))) for n in "ab"]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        numbered = readers.read_lines(spark, *paths, numbered=True).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(numbered) == 800
    assert all(r.value == f"{r.file[-5]} {r.line_no}" for r in numbered)


def test_catalogs(spark, tmp_path):
    (tmp_path / "in").mkdir()
    text_file(tmp_path, "a.txt", "12345")
    text_file(tmp_path / "in", "b.txt", "1")
    top = listing.file_catalog(spark, str(tmp_path)).collect()
    assert [(r.path.rsplit("/", 1)[-1], r.length) for r in top] == [("a.txt", 5)]
    assert listing.file_catalog_recursive(spark, str(tmp_path)).count() == 2
    assert listing.file_catalog_recursive(spark, str(tmp_path), "b.*").count() == 1
    entries = listing.directory_entries(spark, str(tmp_path)).orderBy("name").collect()
    assert [(e.name, e.is_dir) for e in entries] == [("a.txt", False), ("in", True)]
    with pytest.raises(ReadError):
        listing.file_catalog(spark, str(tmp_path / "none"))


def test_list_databases(spark):
    assert rows(listing.list_databases(spark)) == [("default", True)]
    spark.sql("create database second")
    try:
        assert rows(listing.list_databases(spark)) == [("default", False), ("second", False)]
    finally:
        spark.sql("drop database second")


def test_gzip_intermediate(spark):
    base = scratch_dir(spark, "test")
    path = writers.write_gzip_intermediate(spark.range(3), f"{base}/raw/t/")
    assert path == f"{base}/intermediate/t_nppk"
    assert all(e.name.endswith(".gz.parquet") for e in list_children(spark, path))
    assert spark.read.parquet(path).count() == 3


def test_text_blob_is_utf8(spark):
    path = scratch_dir(spark, "test") + "/blob"
    for body in ("première\n€", "première\n€\n"):
        writers.write_text_blob(spark, body, path, mode="overwrite")
        assert [r[0] for r in readers.read_text(spark, path, wholetext=True).collect()] == ["première\n€\n"]
        assert len(list_children(spark, path)) == 1
    writers.write_text_blob(spark, "\n\n", path, mode="overwrite")
    assert readers.read_text(spark, path, wholetext=True).first()[0] == "\n\n"


def test_range_names():
    assert range_name("Sales", 3, 12, ".gz.parquet") == "sales-03in00to11.gz.parquet"
    assert range_name("sales", 0, 1, ".parquet") == "sales-single.parquet"
    assert sorted(["part-100000-x", "part-99999-x"], key=part_order) == ["part-99999-x", "part-100000-x"]
    assert part_order("part-r-00012-x")[0] == 12


def test_write_range_named(spark):
    path = scratch_dir(spark, "Mixed") + "/Sales"
    names = write_range_named(spark.range(1000), path, files=11)
    assert names == [f"sales-{i:02d}in00to10.snappy.parquet" for i in range(11)]
    assert spark.read.parquet(path).count() == 1000
    single = scratch_dir(spark, "test") + "/one"
    assert write_range_named(spark.range(5), single, files=1) == ["one-single.snappy.parquet"]


def test_sparse_parts_get_clean_names(spark):
    path = scratch_dir(spark, "test") + "/sparse"
    spark.range(0, 40, 1, 4).where("id >= 20 or id < 10").write.parquet(path)
    names = rename_parts(spark, path)
    assert names == [f"sparse-{i}in0to2.snappy.parquet" for i in range(3)]
    assert spark.read.parquet(path).count() == 30


def test_nothing_to_rename(spark):
    with pytest.raises(EmptyInputError):
        rename_parts(spark, scratch_dir(spark, "test"))


def test_prefixed_tables(spark):
    assert writers.prefixed_name("stg", "t") == "stg_t"
    assert writers.prefixed_name("stg_", "t") == "stg_t"
    assert writers.prefixed_name("", "t") == "t"
    name = writers.save_prefixed_table(spark.range(2), "numbers", "stg", path=scratch_dir(spark, "test") + "/t")
    assert spark.table("stg_numbers").count() == 2 and name == "stg_numbers"
    spark.sql("drop table stg_numbers")


@pytest.mark.parametrize("fmt", ["parquet", "orc"])
@pytest.mark.parametrize("rebalance", [True, False])
def test_partitioned_sink(spark, fmt, rebalance):
    path = scratch_dir(spark, "test") + "/t"
    frame = spark.range(100).withColumn("load_ts", F.when(F.col("id") < 70, "a").otherwise("b"))
    writers.partitioned_sink(frame, path, ["load_ts"], fmt=fmt, rebalance=rebalance)
    back = spark.read.format(fmt).load(path)
    assert back.where("load_ts = 'a'").count() == 70
    assert [e.name for e in list_children(spark, path)] == ["load_ts=a", "load_ts=b"]


def test_partitioned_sink_splits_a_hot_value(spark):
    path = scratch_dir(spark, "test") + "/t"
    hot = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 40)
    frame = spark.range(0, 120_000, 1, 4).select(F.sha2(F.col("id").cast("string"), 256).alias("h"), hot.alias("load"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "300k")
    try:
        writers.partitioned_sink(frame, path, ["load"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {e.name: len(list_children(spark, e.path)) for e in list_children(spark, path)}
    assert files["load=-1"] > 2 and max(n for name, n in files.items() if name != "load=-1") <= 4
    assert spark.read.parquet(path).count() == 120_000


def test_sql(spark):
    assert rows(sql_query(spark, "select sum(id) as s from numbers where id < :top", {"numbers": spark.range(9)},
                          {"top": 3})) == [(3,)]
    with pytest.raises(SqlError, match="selec nothing") as error:
        sql_query(spark, "selec nothing", code=151)
    assert error.value.code == 151


def test_sql_file(spark, tmp_path, capsys):
    path = text_file(tmp_path, "job.sql", "select count(*) as n\nfrom numbers")
    assert rows(sql_file_job(spark, path, {"numbers": spark.range(4)}, preview_rows=5)) == [(4,)]
    assert "job.sql" in capsys.readouterr().out
    with pytest.raises(EmptyInputError):
        sql_file_job(spark, text_file(tmp_path, "empty.sql", " "))
    with pytest.raises(SqlError):
        sql_file_job(spark, text_file(tmp_path, "bad.sql", "select from where"))
