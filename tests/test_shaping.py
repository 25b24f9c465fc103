"""Previews, names, masks, overlays, row ids, sizes, generated data and incremental loads."""

import datetime
from types import SimpleNamespace

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from tableprep.errors import TablePrepError
from tableprep.operators import generate, masking, overlay, sizing
from tableprep.operators.colnames import (
    common_prefix, reserved_word_columns, safe_column_names, strip_common_prefix,
)
from tableprep.operators.rowid import dense_row_id, surrogate_id
from tableprep.operators.views import preview, schema_report, show_string, view_from_parquet
from tableprep.sinks.writers import write_parquet
from tableprep.storage import clear_scratch, is_directory, list_children, scratch_base, scratch_dir
from tableprep.streaming.incremental import high_water_mark, incremental_load, incremental_stream
from tests.test_reconcile import explained, rows


@pytest.fixture()
def wide(spark):
    return spark.createDataFrame(
        [("abcdefghijklmnopqrstuvwxy", None, bytearray(b"\n\xff"), [1, None, 3])],
        "text string, a_header_that_is_long string, bin binary, list array<int>",
    )


def test_cells(wide):
    assert rows(preview(wide)) == [("abcdefghijklmnopq...", "null", "[0A FF]", "[1, null, 3]")]
    assert preview(wide, width=3).first()[0] == "abc"
    assert preview(wide, width=4).first()[0] == "a..."
    assert len(preview(wide, width=0).first()[0]) == 25


def test_grid(spark, wide):
    grid = show_string(spark.createDataFrame([(1, "b"), (22, "a")], "k int, v string"), 1, order_by=["v"])
    assert grid == "\n+---+---+\n|  k|  v|\n+---+---+\n| 22|  a|\n+---+---+\nonly showing top 1 row\n"
    left = show_string(spark.createDataFrame([(1,)], "k int"), 5, 0)
    assert left == "\n+---+\n|k  |\n+---+\n|1  |\n+---+\n"
    assert "|a_header_that_is_long|" in show_string(wide)
    assert show_string(spark.range(3), 0) == "\n+---+\n| id|\n+---+\n+---+\nonly showing top 0 rows\n"


def test_ordered_preview_is_a_top_k(spark):
    assert "TakeOrderedAndProject" in explained(preview(spark.range(100), 5, order_by=["id"]))


def test_view(spark):
    path = scratch_dir(spark, "test") + "/t"
    spark.range(4).write.parquet(path)
    view_from_parquet(spark, path, "four")
    assert spark.table("four").count() == 4
    with pytest.raises(TablePrepError) as error:
        view_from_parquet(spark, path + "x", "five")
    assert error.value.code == 150


def test_schema_report(spark, wide):
    assert [(r.column, r.type, r.supported) for r in schema_report(wide).orderBy("ordinal").collect()] == [
        ("text", "string", True), ("a_header_that_is_long", "string", True), ("bin", "binary", True),
        ("list", "array<int>", False),
    ]
    assert [r.n_filled for r in schema_report(wide, filled_counts=True).orderBy("ordinal").collect()] == [1, 0, 1, 1]


@pytest.mark.parametrize(
    "names, prefix",
    [
        (["t.id", "t.name"], "t."), (["t.abc", "t.abd"], "t."), (["t.a", "u.b"], ""), (["t.a"], ""), ([], ""),
        (["a.b.c", "a.b.d"], "a.b."), (["a.b.c", "a.d"], "a."), (["abc", "abd"], ""), (["t.a", "t.a.b", "t.ab"], "t."),
    ],
)
def test_common_prefix(names, prefix):
    assert common_prefix(names) == prefix


def test_strip_prefix(spark):
    frame = spark.createDataFrame([(1, 2)], "`t.abc` int, `t.abd` int")
    assert strip_common_prefix(frame).columns == ["abc", "abd"]
    assert rows(strip_common_prefix(frame)) == [(1, 2)]


def test_reserved_words(spark):
    frame = spark.createDataFrame([(1, 2, 3, 4)], "`select` int, `date` int, comment int, amount int")
    assert rows(reserved_word_columns(frame)) == [
        ("amount", False, False), ("comment", False, True), ("date", True, True), ("select", True, True)
    ]
    assert safe_column_names(frame).columns == ["select_", "date_", "comment_", "amount"]


LAYERS = [
    ("db_password", 1, 1, "low"), ("db_password", 2, 1, None), ("aws_access_key_id", 1, 1, "k1"),
    ("aws_access_key_id", 2, 1, "k2"), ("userPasswordFid", 1, 1, "a"), ("userPasswordFid", 1, 2, "b"),
    ("unset", 1, 1, None),
]


def test_overlay_and_mask(spark):
    layers = spark.createDataFrame(LAYERS, "k string, layer int, line int, v string")
    merged = overlay.layered_overlay(layers, "k", "v", ["layer", "line"])
    assert rows(merged) == [
        ("aws_access_key_id", "k2"), ("db_password", "low"), ("unset", None), ("userPasswordFid", "b")
    ]
    assert rows(masking.mask_sensitive(merged, "k", "v")) == [
        ("aws_access_key_id", "XXXXXXXX"), ("db_password", "XXXXXXXX"), ("unset", None), ("userPasswordFid", "b")
    ]


def test_overlay_tables(spark):
    top = spark.createDataFrame([(1, None, 5), (2, "t", None)], "k int, a string, b int")
    middle = spark.createDataFrame([(1, "m", 7)], "K int, A string, b int")
    base = spark.createDataFrame([(1, "x", "c"), (3, "y", "d")], "k int, a string, c string")
    assert rows(overlay.overlay_tables([top, middle, base], ["k"])) == [
        (1, "m", 5, "c"), (2, "t", None, None), (3, "y", None, "d")
    ]
    assert explained(overlay.overlay_tables([top, middle, base], ["k"])).split("\n\n\n")[0].count("Exchange") == 1


CELLS = st.one_of(st.none(), st.integers(0, 3))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.tuples(st.integers(0, 4), CELLS, CELLS), max_size=6), min_size=1, max_size=3))
def test_overlay_of_anything(spark, layers):
    frames = [spark.createDataFrame(layer, "k int, a int, b int") for layer in layers]
    expected = {}
    for layer in reversed(layers):
        for k in {row[0] for row in layer}:
            below = expected.get(k, (None, None))
            tops = [max((row[i] for row in layer if row[0] == k and row[i] is not None), default=None) for i in (1, 2)]
            expected[k] = tuple(b if t is None else t for t, b in zip(tops, below, strict=True))
    assert rows(overlay.overlay_tables(frames, ["k"])) == sorted(((k, *v) for k, v in expected.items()), key=repr)


def test_equal_ranks_and_maps(spark):
    tied = spark.createDataFrame([("k", 1, "a"), ("k", 1, "b"), ("k", 0, "z")], "k string, layer int, v string")
    assert rows(overlay.layered_overlay(tied, "k", "v", ["layer"])) == [("k", "b")]
    maps = spark.sql("select 1 as k, map('x', 1) as m")
    assert rows(overlay.overlay_tables([maps, maps], ["k"])) == [(1, {"x": 1})]


def test_masked_columns_are_not_read(spark):
    path = scratch_dir(spark, "test") + "/t"
    spark.createDataFrame([(1, "p", "f")], "k int, DB_Password string, passwordFid string").write.parquet(path)
    masked = masking.mask_columns(spark.read.parquet(path))
    assert rows(masked) == [(1, "XXXXXXXX", "f")]
    assert "ReadSchema: struct<k:int,passwordFid:string>" in explained(masked)


def test_surrogate_ids(spark):
    got = surrogate_id(spark.range(0, 1000, 1, 7), offset=10**12).agg(
        F.count_distinct("seqnum"), F.min("seqnum")
    ).first()
    assert tuple(got) == (1000, 10**12)


def test_dense_ids_equal_a_global_window(spark):
    frame = spark.range(0, 5000, 1, 6).select(
        (F.col("id") * 7919 % 5000).alias("k"), F.when(F.col("id") % 5 > 0, F.col("id") % 17).alias("d")
    )
    expected = frame.withColumn("row_id", F.row_number().over(Window.orderBy("d", "k")))
    assert rows(dense_row_id(frame, ["d", "k"], num_partitions=13)) == rows(expected)


def test_dense_ids_of_one_hot_row(spark):
    frame = spark.range(0, 6000, 1, 8).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    path = scratch_dir(spark, "test") + "/ids"
    ids = dense_row_id(frame, ["k"], num_partitions=12, location=path)
    assert [r[0] for r in ids.orderBy("row_id").select("row_id").collect()] == list(range(1, 6001))
    assert ids.where("k = 0").agg(F.max("row_id")).first()[0] == 2000
    largest = spark.read.parquet(path).groupBy("_metadata.file_name").count().agg(F.max("count")).first()[0]
    assert largest < 2000  # the hot value alone is a third of the rows and does not end up in one task


def test_a_column_is_numbered_anew_in_its_place(spark):
    frame = spark.createDataFrame([(9, "b"), (9, "a")], "Seq int, k string")
    result = dense_row_id(frame, ["k"], "seq", start=0)
    assert result.dtypes == [("seq", "bigint"), ("k", "string")]
    assert rows(result) == [(0, "a"), (1, "b")]


def test_key_ranges_follow_the_size_of_a_scan(spark):
    base = scratch_dir(spark, "test")
    spark.range(0, 900, 1, 9).write.parquet(f"{base}/in")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        ids = dense_row_id(spark.read.parquet(f"{base}/in"), ["id"], location=f"{base}/ids")
        assert ids.where("row_id = id + 1").count() == 900
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(list_children(spark, f"{base}/ids")) >= 9  # the tests set four shuffle partitions


def test_dense_ids_of_nothing(spark):
    assert dense_row_id(spark.range(0), ["id"]).count() == 0


def test_recommended_files(spark):
    path = scratch_dir(spark, "test") + "/t"
    spark.range(0, 80000, 1, 8).select(F.sha2(F.col("id").cast("string"), 256).alias("h")).write.parquet(path)
    table = spark.read.parquet(path)
    most = sizing.recommend_partitions(table, sample_pieces=100).first()
    assert most.n_rows == 80000 and most.recommended == 1
    size = most.sampled_bytes * most.n_rows // most.sampled_rows
    part = sizing.recommend_partitions(table, target_bytes=size // 10, sample_pieces=3).first()
    assert 10000 <= part.sampled_rows <= 30000 and 9 <= part.recommended <= 11
    derived = sizing.recommend_partitions(table.groupBy("h").count(), sample_pieces=2).first()
    assert derived.n_rows == 80000 and derived.recommended == 1
    assert sizing.recommend_partitions(table.where("h = ''")).first().recommended == 1


def test_sampling_scans_only_the_chosen_files(spark):
    path = scratch_dir(spark, "test") + "/t"
    spark.range(0, 800, 1, 8).write.parquet(path)
    table = spark.read.parquet(path)
    one = table.select("_metadata.file_path").first()[0]
    chosen = table.where(F.col("_metadata.file_path").isin([one]))
    assert chosen.rdd.getNumPartitions() == 1 and chosen.count() == 100


def test_compaction(spark):
    base = scratch_dir(spark, "test")
    spark.range(0, 4000, 1, 40).write.parquet(f"{base}/small")
    plan = sizing.compaction_plan(spark, base).first()
    assert plan.files == 40 and plan.recommended == 1 and plan.directory.endswith("/small")
    assert sizing.compact(spark, f"{base}/small", f"{base}/one") == 1
    assert len(list_children(spark, f"{base}/one")) == 1
    wanted = sizing.compact(spark, f"{base}/one", f"{base}/many", target_bytes=3000)
    assert len(list_children(spark, f"{base}/many")) == wanted > 1
    assert spark.read.parquet(f"{base}/many").count() == 4000


def test_compaction_of_a_partitioned_table(spark):
    base = scratch_dir(spark, "test")
    part = F.when(F.col("id") % 3 > 0, "hot one").otherwise(F.concat(F.lit("p"), F.col("id") % 5))
    frame = spark.range(0, 30000, 1, 12).select("id", F.sha2(F.col("id").cast("string"), 256).alias("h"), part.alias("p"))
    frame.write.partitionBy("p").parquet(f"{base}/small")
    sizing.compact(spark, f"{base}/small", f"{base}/sized", target_bytes=300_000, by=["p"])
    files = {e.name: len(list_children(spark, e.path)) for e in list_children(spark, f"{base}/sized")}
    assert len(files) == 6 and files.pop("p=hot one") >= 3 and set(files.values()) == {1}
    back = spark.read.parquet(f"{base}/sized")
    assert back.exceptAll(frame.select(back.columns)).isEmpty() and back.count() == 30000


def test_rounding_of_file_counts(spark):
    sizes = spark.createDataFrame([(0,), (127_999_999,), (384_000_000,), (383_999_999,), (10**15,)], "b bigint")
    assert [r[0] for r in sizes.select(sizing.files_for(F.col("b"))).collect()] == [1, 1, 2, 1, 3906250]


def test_pi(spark):
    got = generate.estimate_pi(spark, 200_000, seed=3).first()
    assert got.samples == 200_000 and abs(got.pi - 3.14159) < 0.02


def test_bulk(spark):
    blocks = generate.generate_bulk(spark, 2, seed=1)
    assert tuple(blocks.agg(F.sum(F.octet_length("block")), F.count_distinct("block")).first()) == (2 * 2**20, 2048)


def test_incremental_load(spark):
    source = spark.range(10)
    assert rows(incremental_load(source, source.where("id < 7"), "id")) == [(7,), (8,), (9,)]
    assert incremental_load(source, source.where("id < 0"), "id").count() == 10
    assert high_water_mark(source.where("id < 0"), "id") is None


def test_incremental_load_by_time_reaches_the_scan(spark):
    path = scratch_dir(spark, "test") + "/t"
    days = spark.range(10).select(F.expr("timestamp_ntz'2020-01-01' + make_dt_interval(id)").alias("ts"))
    write_parquet(days, path)
    table = spark.read.parquet(path)
    new = incremental_load(table, days.where(F.col("ts") < datetime.datetime(2020, 1, 8)), "ts")
    assert new.count() == 3
    assert "GreaterThan(ts," in explained(new)


def test_stream_loads_every_file_once(spark):
    base = scratch_dir(spark, "test")
    spark.range(0, 5).write.parquet(f"{base}/in")
    schema = spark.range(1).schema

    def load():
        incremental_stream(spark, f"{base}/in", schema, f"{base}/out", f"{base}/progress", files_per_batch=1)
        return spark.read.parquet(f"{base}/out").count()

    assert load() == 5
    assert load() == 5
    spark.range(5, 9).write.mode("append").parquet(f"{base}/in")
    assert load() == 9


def test_scratch_is_dropped_on_request(spark):
    path = scratch_dir(spark, "test")
    assert is_directory(spark, path)
    clear_scratch(spark)
    assert not is_directory(spark, path)


def session(folder, master):
    """Just enough of a session to choose a scratch folder."""
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: folder),
        sparkContext=SimpleNamespace(master=master, applicationId="app"),
    )


def test_scratch_folder():
    assert scratch_base(session("hdfs://shared/checkpoints/", "yarn")) == "hdfs://shared/checkpoints"
    with pytest.raises(TablePrepError, match="spark.checkpoint.dir"):
        scratch_base(session(None, "yarn"))
    assert scratch_base(session(None, "local[2]")) == scratch_base(session(None, "local[2]"))

