"""Columns called as those that operators make, ids that stay, rows that come late, and tables published whole."""

import datetime
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tableprep import (
    char_class_totals, char_histogram, dense_row_id, hyphen_position, incremental_load, overlay_tables, reproducible_id, surrogate_id,
    write_range_named,
)
from tableprep.errors import SchemaError, WriteError
from tableprep.operators.profile import character_counts
from tableprep.sinks import range_named
from tableprep.storage import list_children, scratch_dir


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_names_of_profiles_are_refused(spark):
    frame = spark.createDataFrame([("-a", 1, 2, 3)], "t string, N int, bucket int, leading int")
    for call in (lambda: char_histogram(frame, "t", ["bucket"]), lambda: character_counts(frame, "t", ["N"]),
                 lambda: char_class_totals(frame, "t", ["leading"]), lambda: hyphen_position(frame, "t")):
        with pytest.raises(SchemaError, match="of its own"):
            call()
    assert char_histogram(frame, "t", ["leading"]).count() == 2


def test_names_inside_overlays_and_ids(spark):
    one = spark.createDataFrame([(1, None, "a")], "k int, rank int, __rank string")
    two = spark.createDataFrame([(1, 7, "b")], "k int, rank int, __rank string")
    assert rows(overlay_tables([one, two], ["k"])) == [(1, 7, "a")]
    frame = spark.createDataFrame([(2, "x", "o", 5, 6), (1, "y", "p", 5, 6)], "k int, __file string, origin string, row int, shift int")
    assert rows(dense_row_id(frame, ["k"])) == [(1, "y", "p", 5, 6, 1), (2, "x", "o", 5, 6, 2)]
    again = surrogate_id(spark.range(3).withColumn("SeqNum", F.lit(-1)))
    assert again.columns == ["id", "seqnum"] and again.where("seqnum < 0").count() == 0


def test_reproducible_ids(spark):
    base = scratch_dir(spark, "test") + "/a b%t"
    spark.range(0, 4000, 1, 5).select("id", F.lit("x").alias("path"), F.lit(1).alias("rank")).write.option("parquet.block.size", 4096).parquet(base)
    first = {r.id: r.seqnum for r in reproducible_id(spark.read.parquet(base), offset=7).collect()}
    assert len(set(first.values())) == 4000 and min(first.values()) == 7
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        cut = reproducible_id(spark.read.parquet(base).where("id % 3 = 0"), offset=7)
        assert cut.rdd.getNumPartitions() > 5
        found = {r.id: r.seqnum for r in cut.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == {i: n for i, n in first.items() if i % 3 == 0}
    with pytest.raises(SchemaError):
        reproducible_id(spark.range(3))


def test_late_rows_are_loaded_once(spark):
    day = datetime.datetime(2024, 10, 27, 1, 30)
    make = lambda *rows: spark.createDataFrame([(i, day + datetime.timedelta(hours=h) if h is not None else None) for i, h in rows], "id int, at timestamp")
    target = make((1, 0), (2, 5), (None, 5), (9, None))
    source = make((1, 0), (2, 5), (3, 5), (None, 5), (4, 3), (5, 9), (6, -9), (7, None))
    ids = lambda frame: sorted((r.id for r in frame.collect()), key=repr)
    assert ids(incremental_load(source, target, "at")) == [5]
    assert ids(incremental_load(source, target, "at", ["id"])) == [3, 5]
    late = incremental_load(source, target, "at", ["id"], datetime.timedelta(hours=3))
    assert ids(late) == [3, 4, 5]
    assert ids(incremental_load(source, target.union(late), "at", ["id"], datetime.timedelta(hours=9))) == []
    assert ids(incremental_load(source, target.limit(0), "at", ["id"])) == ids(source)
    numbers = incremental_load(spark.range(10), spark.range(6), "id", ["id"], 3)
    assert ids(numbers) == [6, 7, 8, 9]


def test_a_failed_publication_leaves_the_old_table(spark, monkeypatch):
    path = scratch_dir(spark, "test") + "/Table"
    names = write_range_named(spark.range(10), path, files=2)
    assert names == ["table-0in0to1.snappy.parquet", "table-1in0to1.snappy.parquet"]
    with pytest.raises(WriteError):
        write_range_named(spark.range(3), path)
    assert write_range_named(spark.range(3), path, mode="ignore") == [] and spark.read.parquet(path).count() == 10
    true_rename = range_named.rename

    def failing(at):
        calls = iter(range(100))
        return lambda s, a, b: False if next(calls) == at else true_rename(s, a, b)

    for at in (0, 1, 2, 3):  # the files of the staged table, the old table moved aside, the new one published
        monkeypatch.setattr(range_named, "rename", failing(at))
        with pytest.raises(WriteError):
            write_range_named(spark.range(5), path, files=2, mode="overwrite")
        assert spark.read.parquet(path).count() == 10
        parent = path.rsplit("/", 1)[0]
        assert [e.name for e in list_children(spark, parent)] == ["Table"]
    monkeypatch.setattr(range_named, "rename", true_rename)
    write_range_named(spark.range(5), path, files=1, mode="overwrite")
    assert spark.read.parquet(path).count() == 5
    manifest = Path(re.sub("^file:/+", "/", f"{path}/{range_named.MANIFEST}")).read_text()
    size = next(e.length for e in list_children(spark, path))
    assert manifest == f"table-single.snappy.parquet\t{size}\n"


def test_ids_by_bounds_and_by_written_ranges(spark):
    base = scratch_dir(spark, "test")
    hot = F.when(F.col("id") % 3 > 0, F.lit("hot")).when(F.col("id") % 2 == 0, F.col("id").cast("string"))
    spark.range(0, 3000, 1, 3).select("id", hot.alias("k"), F.lit(0).alias("row_id"), F.lit("p").alias("path")).write.parquet(f"{base}/t")
    table = spark.read.parquet(f"{base}/t")
    quick = dense_row_id(table, ["k", "id"], start=5, num_partitions=7)
    written = dense_row_id(table, ["k", "id"], start=5, num_partitions=7, location=f"{base}/ids")
    assert rows(quick) == rows(written) and quick.dtypes == written.dtypes
    assert not any(e.name.startswith("tableprep-rowid") for e in list_children(spark, base))
    tied = dense_row_id(table, ["k"], num_partitions=9)
    assert [r.row_id for r in tied.orderBy("row_id").collect()] == list(range(1, 3001))
    keys = [r.k for r in tied.orderBy("row_id").collect()]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or ""))
    assert rows(tied) == rows(dense_row_id(table, ["k"], num_partitions=4))
    assert dense_row_id(table.drop("row_id"), ["k"]).columns == ["id", "k", "path", "row_id"]
    assert dense_row_id(table.where("id < 0"), ["k"]).count() == 0 and dense_row_id(table.limit(1), ["k"]).first().row_id == 1


def test_characters_of_malformed_and_mixed_texts(spark):
    values = [b"a\xff", b"\xc3", b"\xa9x", "é€😀".encode(), b"", b"plain", None, b"\x80\x80"]
    for some in ([values[3], values[4], values[5]], [values[5]] * 3, values, [values[1], values[2]]):
        frame = spark.createDataFrame([(bytearray(v) if v is not None else None,) for v in some], "t binary").coalesce(1)
        want = {}
        for v in some:
            for c in (v or b"").decode("utf-8", "replace"):
                want[ord(c)] = want.get(ord(c), 0) + 1
        assert {r.code_point: r.n for r in character_counts(frame.select(F.col("t").cast("string").alias("t")), "t").collect()} == want
