"""Sampling of runs: which rows are written, how far the estimate may be off, and what is never written whole."""

from pyspark.sql import functions as F

from tableprep.operators import sizing
from tableprep.storage import list_children, scratch_dir


def texts(spark, rows, parts):
    value = F.sha2(F.col("id").cast("string"), 256).alias("h")
    return spark.range(0, rows, 1, parts).select("id", value)


def gzip_bytes(spark, frame, path):
    frame.write.option("compression", "gzip").parquet(path)
    return sum(e.length for e in list_children(spark, path))


def test_one_large_file_is_not_written_whole(spark):
    base = scratch_dir(spark, "test")
    texts(spark, 400_000, 8).coalesce(1).write.option("parquet.block.size", 1 << 20).parquet(f"{base}/t")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 1 << 20)
    try:
        table = spark.read.parquet(f"{base}/t")
        assert table.rdd.getNumPartitions() >= 20
        found = sizing.recommend_partitions(table, target_bytes=1 << 20).first()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found.n_rows == 400_000 and 4 * sizing.RUN_ROWS >= found.sampled_rows >= sizing.RUN_ROWS
    true = gzip_bytes(spark, table, f"{base}/whole")
    assert abs(found.estimated_bytes - true) < 0.1 * true and found.bytes_error is not None
    assert found.recommended == round(found.estimated_bytes / (1 << 20))


def test_a_byte_budget_shortens_the_runs(spark):
    base = scratch_dir(spark, "test")
    texts(spark, 100_000, 4).write.parquet(f"{base}/t")
    size = sum(e.length for e in list_children(spark, f"{base}/t"))
    found = sizing.recommend_partitions(spark.read.parquet(f"{base}/t"), sample_bytes=size // 50).first()
    assert 1000 < found.sampled_rows <= 2100


def test_days_are_drawn_by_hash(spark):
    base = scratch_dir(spark, "test")
    days = texts(spark, 40_000, 40).withColumn("d", F.format_string("d%03d", F.spark_partition_id()))
    days.write.partitionBy("d").parquet(f"{base}/t")
    drawn = sizing._drawn_runs(spark.read.parquet(f"{base}/t"), 4, sizing.SAMPLE_BYTES)
    assert drawn.runs == 40 and len(set(drawn.paths)) == 4


def test_uneven_runs_widen_the_error(spark):
    base = scratch_dir(spark, "test")
    even = texts(spark, 64_000, 32)
    uneven = even.withColumn("h", F.when(F.spark_partition_id() % 2 == 0, F.col("h")).otherwise("x"))
    found = []
    for name, frame in (("even", even), ("uneven", uneven)):
        frame.write.parquet(f"{base}/{name}")
        found.append(sizing.recommend_partitions(spark.read.parquet(f"{base}/{name}"), sample_pieces=8).first())
    assert found[0].bytes_error < found[1].bytes_error
    true = gzip_bytes(spark, uneven, f"{base}/whole")
    assert abs(found[1].estimated_bytes - true) <= max(found[1].bytes_error, true // 10)


def test_other_frames(spark):
    base = scratch_dir(spark, "test")
    table = texts(spark, 50_000, 5).withColumn("lot", F.col("id"))
    table.write.parquet(f"{base}/t")
    table.write.csv(f"{base}/c")
    scan = spark.read.parquet(f"{base}/t")
    rare = scan.where("id >= 49990").select("h", "lot")
    assert sizing.recommend_partitions(rare).first()[:2] == (10, 10)
    csv = sizing.recommend_partitions(spark.read.csv(f"{base}/c")).first()
    assert csv.n_rows == 50_000 and csv.sampled_rows in (20_000, 30_000, 40_000)
    derived = sizing.recommend_partitions(scan.groupBy("h").agg(F.max("id").alias("id"))).first()
    assert derived.n_rows == 50_000 and 1 <= derived.sampled_rows <= 4 * sizing.DERIVED_RUN_ROWS
    nothing = sizing.recommend_partitions(scan.where("h = ''")).first()
    assert (nothing.n_rows, nothing.sampled_rows, nothing.estimated_bytes, nothing.recommended) == (0, 0, 0, 1)
