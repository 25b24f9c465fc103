"""How many files a table should be written to, and rewriting it that way."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T

from tableprep.errors import WriteError, guard
from tableprep.functions.columns import fresh_name, is_plain_scan, quoted, source_path
from tableprep.functions.fixed import TARGET_FILE_BYTES
from tableprep.sinks.writers import ERROR, write_parquet
from tableprep.sources.listing import file_catalog_recursive
from tableprep.sources.readers import read_parquet
from tableprep.storage import scratch_dir

BROADCAST_DIRECTORIES = 100_000
SAMPLE_BYTES = 64 << 20
RUN_ROWS = 1 << 14
DERIVED_RUN_ROWS = 1 << 12


def files_for(size: Column, target_bytes: int = TARGET_FILE_BYTES) -> Column:
    """Whole files of about ``target_bytes`` that ``size`` bytes fill; at least one."""
    return F.greatest(F.lit(1), F.floor(F.lit(0.5) + size / F.lit(float(target_bytes)))).cast("bigint")


@dataclass(frozen=True)
class _Runs:
    """How the rows of a frame fall into runs of neighbours, and the few runs that were drawn."""

    rows: int
    runs: int
    drawn: list[Column]
    paths: list[str]


def _draw(runs: DataFrame, unit: Sequence[str], pieces: int) -> DataFrame:
    """One run for each of ``pieces`` lots, the one of least hash, and what all runs of the lot hold."""
    place = F.xxhash64(*unit)
    lots = runs.groupBy(F.pmod(place, F.lit(pieces)).alias("lot"))
    return lots.agg(F.sum("n").alias("n"), F.count("*").alias("runs"), F.min_by(F.struct(*unit, "size"), place).alias("unit"))


def _within(bytes_wanted: int, picked: list) -> list:
    """The lots whose runs fit the byte budget together, two at least, so that their spread can be told."""
    kept, held = [], 0
    for lot in sorted(picked, key=lambda lot: lot.lot):
        held += lot.unit.size
        if len(kept) < 2 or held <= bytes_wanted:
            kept.append(lot)
    return kept


def _drawn_runs(frame: DataFrame, pieces: int, sample_bytes: int) -> _Runs:
    """Runs of rows of a Parquet scan by their place in the file, short enough for the byte budget; of another scan the
    splits of its files; of a derived frame runs of rows of its partitions."""
    path = F.col("_metadata.file_path")
    if is_plain_scan(frame, "row_index"):
        row = F.col("_metadata.row_index")
        files = frame.groupBy(path.alias("path")).agg(
            F.count("*").alias("n"), (F.max(row) + 1).alias("rows"), F.max("_metadata.file_size").alias("size"))
        total = files.agg(F.sum("n").alias("n"), F.sum("rows").alias("rows"), F.sum("size").alias("size")).first()
        width = max(1.0, (total.size or 0) / max(1, total.rows or 0))
        length = int(min(RUN_ROWS, max(1, sample_bytes / pieces / width)))
        if total.n == total.rows:
            runs = files.select("path", F.explode(F.sequence(F.lit(0), F.floor((F.col("rows") - 1) / length))).alias("run"), "n")
        else:  # a filter may leave runs without a row
            runs = frame.groupBy(path.alias("path"), F.floor(row / length).alias("run")).agg(F.count("*").alias("n"))
        runs = runs.withColumn("size", F.lit(int(length * width)))
        picked = _draw(runs, ["path", "run"], pieces).collect()
        drawn = [
            (path == lot.unit.path) & row.between(lot.unit.run * length, (lot.unit.run + 1) * length - 1)
            for lot in _within(sample_bytes, picked)]
        return _Runs(total.n or 0, sum(lot.runs for lot in picked), drawn, [lot.unit.path for lot in picked])
    if is_plain_scan(frame):
        start = F.col("_metadata.file_block_start")
        runs = frame.groupBy(path.alias("path"), start.alias("start")).agg(
            F.count("*").alias("n"), F.max("_metadata.file_block_length").alias("size"))
        picked = _draw(runs, ["path", "start"], pieces).collect()
        # a scan of fewer files may cut them finer, so a split is a range of places
        drawn = [
            (path == lot.unit.path) & start.between(lot.unit.start, lot.unit.start + lot.unit.size - 1)
            for lot in _within(sample_bytes, picked)]
        return _Runs(sum(lot.n for lot in picked), sum(lot.runs for lot in picked), drawn, [lot.unit.path for lot in picked])
    run = F.floor(F.monotonically_increasing_id() / DERIVED_RUN_ROWS)
    runs = frame.groupBy(run.alias("run")).agg(F.count("*").alias("n"), F.lit(0).alias("size"))
    picked = _draw(runs, ["run"], pieces).collect()
    return _Runs(
        sum(lot.n for lot in picked), sum(lot.runs for lot in picked), [run == lot.unit.run for lot in picked], [])


def _estimate(drawn: Sequence[Row], rows: int, runs: int) -> tuple[int, int | None]:
    """Bytes of all rows by the ratio of bytes to rows in the runs drawn, and two standard errors of it."""
    size, held = sum(run.bytes for run in drawn), sum(run.n for run in drawn)
    if not held:
        return 0, None
    ratio, many = size / held, len(drawn)
    if many < 2:
        return round(ratio * rows), None
    spread = sum((run.bytes - ratio * run.n) ** 2 for run in drawn) / (many - 1)
    return round(ratio * rows), round(2 * runs * (max(0.0, 1 - many / runs) * spread / many) ** 0.5)


def _written(sample: DataFrame, lot: str) -> list[Row]:
    """(n, bytes) of each lot of ``sample`` as gzip Parquet in the scratch folder."""
    spark = sample.sparkSession
    location = scratch_dir(spark, "sizing") + "/sample"
    with guard(WriteError, f"cannot write a sample to {location}"):
        sample.write.partitionBy(lot).option("compression", "gzip").parquet(location)
    rows = read_parquet(spark, location, schema=T.StructType([T.StructField(lot, T.IntegerType())]))
    files = rows.groupBy(quoted(lot).alias("lot"), "_metadata.file_path").agg(
        F.count("*").alias("n"), F.max("_metadata.file_size").alias("bytes"))
    return files.groupBy("lot").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes")).collect()


def recommend_partitions(
    frame: DataFrame, target_bytes: int = TARGET_FILE_BYTES, sample_pieces: int = 4, sample_bytes: int = SAMPLE_BYTES
) -> DataFrame:
    """(n_rows, sampled_rows, sampled_bytes, estimated_bytes, bytes_error, recommended): files to write ``frame`` to as
    gzip Parquet.

    Rows are counted first, without their columns. Then ``sample_pieces`` runs of neighbouring rows, drawn by hash, are
    written to the scratch folder, about ``sample_bytes`` of the source in all, and the ratio of bytes to rows is scaled
    up. ``bytes_error`` is two standard errors, from how far the runs differ; null where one run is all there is. Only the
    files that hold drawn runs are opened for that, and the frame is never written whole unless it is as small as
    the runs. A derived frame is computed twice.
    """
    spark = frame.sparkSession
    found = _drawn_runs(frame, sample_pieces, sample_bytes)
    lot = fresh_name(frame, "lot")
    number = F.coalesce(*[F.when(held, i) for i, held in enumerate(found.drawn)], F.lit(None).cast("int"))
    sample = frame.where(F.col("_metadata.file_path").isin(found.paths)) if found.paths else frame
    drawn = _written(sample.select("*", number.alias(lot)).where(quoted(lot).isNotNull()), lot)
    if not drawn and found.rows:  # rows of a derived frame may fall into other partitions in another run
        drawn = _written(frame.limit(DERIVED_RUN_ROWS).withColumn(lot, F.lit(0)), lot)
    rows, error = _estimate(drawn, found.rows, found.runs)
    facts = spark.createDataFrame(
        [(found.rows, sum(run.n for run in drawn), sum(run.bytes for run in drawn), rows, error)],
        "n_rows bigint, sampled_rows bigint, sampled_bytes bigint, estimated_bytes bigint, bytes_error bigint")
    return facts.select("*", files_for(F.col("estimated_bytes"), target_bytes).alias("recommended"))


def _directory(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]+$", 1)


def _one_slash(path: Column) -> Column:
    """A path with one slash after its scheme: listings and scans disagree on their number."""
    return F.regexp_replace(path, r"^([A-Za-z0-9]+):/+", "$1:/")


def compaction_plan(
    spark: SparkSession, directory: str, target_bytes: int = TARGET_FILE_BYTES, glob: str = "*.parquet"
) -> DataFrame:
    """(directory, files, bytes, recommended) for every directory below ``directory`` that holds files."""
    files = file_catalog_recursive(spark, directory, glob)
    sizes = files.groupBy(_directory(F.col("path")).alias("directory")).agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes")
    )
    return sizes.select("*", files_for(F.col("bytes"), target_bytes).alias("recommended"))


def compact(
    spark: SparkSession,
    source: str,
    target: str,
    target_bytes: int = TARGET_FILE_BYTES,
    mode: str = ERROR,
    by: Sequence[str] = (),
) -> int:
    """Rewrite the Parquet table at ``source`` to ``target`` in the recommended number of files; returns it.

    Many small files are merged by joining scan tasks, without a shuffle; only a table with fewer tasks than files
    wanted is spread out. With ``by``, the columns the table is partitioned by on disk, every directory gets its own
    number of files, all in one job: rows are dealt out by their place in their file, so a directory with very many
    rows is shared by many tasks. Their values are written back as they stand in the paths. Files at any depth and of
    any name are taken; a table partitioned on disk is refused without ``by``.
    """
    table = read_parquet(spark, source, recursiveFileLookup=True)
    path = _one_slash(source_path())
    # sizes come from the scan itself, so every file it reads is planned, whatever its name or depth
    files = table.groupBy(path.alias("path")).agg(F.first("_metadata.file_size").alias("length"))
    if not by and not files.where(F.col("path").rlike(r"/[^/=]+=[^/]*/[^/]+$")).isEmpty():
        raise WriteError(f"{source} is partitioned on disk; name its columns in by")
    plan = files.groupBy(_directory(F.col("path")).alias("__directory")).agg(
        files_for(F.sum("length"), target_bytes).alias("recommended"))
    wanted = plan.agg(F.coalesce(F.sum("recommended"), F.lit(1))).first()[0]
    if not by:
        tasks = table.rdd.getNumPartitions()
        write_parquet(table.coalesce(wanted) if tasks >= wanted else table.repartition(wanted), target, mode)
        return wanted
    few = plan.count() <= BROADCAST_DIRECTORIES
    plan = F.broadcast(plan) if few else plan
    place = F.xxhash64("_metadata.file_path", "_metadata.row_index")
    names = [_value_in_path(path, name).alias(name) for name in by]
    dealt = (
        table.select("*", *names, _directory(path).alias("__directory"), place.alias("__place"))
        .join(plan, "__directory", "left")
        .withColumn("__file", F.pmod("__place", F.coalesce("recommended", F.raise_error(F.lit("a directory without a plan")))))
        .repartition(wanted, "__directory", "__file")
    )
    with guard(WriteError, f"cannot write parquet to {target}"):
        dealt.select(*[quoted(c) for c in [*table.columns, *by]]).write.mode(mode).partitionBy(*by).parquet(target)
    return wanted


def _value_in_path(path: Column, name: str) -> Column:
    """The text after ``name=`` in a path, as it stands there: ``01`` stays ``01``."""
    value = F.regexp_extract(path, "/" + re.escape(name) + "=([^/]*)/", 1)
    plain = F.when(value.contains("%"), F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B")))).otherwise(value)
    return F.when(value != "__HIVE_DEFAULT_PARTITION__", plain)
