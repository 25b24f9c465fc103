"""Row ids that many tasks hand out at once."""

from __future__ import annotations

import re
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tableprep.errors import SchemaError
from tableprep.functions.columns import fresh_name, is_plain_scan, quoted
from tableprep.storage import part_order, scratch_dir

BROADCAST_FILES = 100_000
MOST_BOUNDS = 256
SKETCH_PER_RANGE = 32
#: Key types whose values survive the way through Python as they are.
LITERAL_KEYS = (
    T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType, T.DateType, T.TimestampNTZType, T.DecimalType, T.BooleanType)
#: Bits of an id for the place in a file: up to 8 billion rows.
FILE_ROW_BITS = 33


def _numbered(frame: DataFrame, name: str, row_id: Column) -> list[Column]:
    """The columns of ``frame`` with ``row_id`` in the place of a column already called ``name``, else in front."""
    if name.lower() not in [c.lower() for c in frame.columns]:
        return [row_id.alias(name), *[quoted(c) for c in frame.columns]]
    return [row_id.alias(name) if c.lower() == name.lower() else quoted(c) for c in frame.columns]


def _in_place(frame: DataFrame, name: str, row_id: Column) -> list[Column]:
    """As ``_numbered``, but the ids come last where no column gives way to them."""
    first, *others = _numbered(frame, name, row_id)
    return [first, *others] if len(others) < len(frame.columns) else [*others, first]


def surrogate_id(frame: DataFrame, name: str = "seqnum", offset: int = 0) -> DataFrame:
    """Unique, not dense ids in front of the columns; narrow, no shuffle. Ids change when the job runs again. A column
    already called ``name`` is numbered anew in its place.

    Meant for rows straight from files: after a shuffle a repeated task may meet its rows in another order, and rows
    already passed on would keep the old ids; ``reproducible_id`` has no such limit.
    """
    return frame.select(*_numbered(frame, name, F.monotonically_increasing_id() + F.lit(offset).cast("bigint")))


def reproducible_id(frame: DataFrame, name: str = "seqnum", offset: int = 0) -> DataFrame:
    """Unique, not dense ids that only depend on where a row is stored: the rank of its file among the files of the frame,
    by path, and its place in the file.

    Equal on every run, however the scan is cut into tasks, whatever filters and columns are chosen and after lost
    executors, as long as the files stay. For frames that come straight from Parquet files; others are an error. The
    ranks are one row for each file, broadcast up to ``BROADCAST_FILES`` of them.
    """
    if not is_plain_scan(frame, "row_index"):
        raise SchemaError("rows have a place of their own only straight from Parquet files; use surrogate_id")
    spark = frame.sparkSession
    path, rank = fresh_name(frame, "path"), fresh_name(frame, "rank")
    files = sorted({re.sub("^([A-Za-z0-9]+):/+", r"\1:/", file) for file in frame.inputFiles()})
    ranks = spark.createDataFrame([(file, i) for i, file in enumerate(files)], T.StructType([
        T.StructField(path, T.StringType()), T.StructField(rank, T.LongType())]))
    if len(files) <= BROADCAST_FILES:
        ranks = F.broadcast(ranks)
    row = fresh_name(frame, "row")
    here = F.regexp_replace("_metadata.file_path", "^([A-Za-z0-9]+):/+", "$1:/")
    placed = frame.select("*", here.alias(path), F.col("_metadata.row_index").alias(row)).join(ranks, path, "left")
    known = F.coalesce(F.col(rank), F.raise_error(F.lit("a file that was not listed")).cast("bigint"))
    return placed.select(*_numbered(frame, name, F.shiftleft(known, FILE_ROW_BITS) + F.col(row) + F.lit(offset).cast("bigint")))


def _ranges(frame: DataFrame) -> int | None:
    """As many key ranges as the scan has tasks, if those outnumber the shuffle partitions; else Spark decides."""
    if not is_plain_scan(frame):
        return None
    tasks = frame.rdd.getNumPartitions()
    return tasks if tasks > int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions")) else None


def _range_of(keys: Sequence[Column], bounds: Sequence[Sequence[Column]], first: int = 0) -> Column:
    """Which of the ranges between ``bounds`` a row falls into, by halving."""
    if not bounds:
        return F.lit(first)
    middle = len(bounds) // 2
    below, above = _range_of(keys, bounds[:middle], first), _range_of(keys, bounds[middle + 1:], first + middle + 1)
    return F.when(F.struct(*keys) < F.struct(*bounds[middle]), below).otherwise(above)


def _by_bounds(frame: DataFrame, keys: Sequence[str], name: str, start: int, ranges: int) -> DataFrame:
    """Ids without a write: bounds from a uniform sketch of the keys become literals of the plan, one scan of the keys counts
    the rows of each range, and a window in each range numbers them behind the ranges before it. Path and place in the
    file stand behind the keys, so runs of equal keys are split too, and every scan agrees on who comes first."""
    path, row, number = (fresh_name(frame, taken) for taken in ("path", "row", "range"))
    placed = frame.select("*", F.col("_metadata.file_path").alias(path), F.col("_metadata.row_index").alias(row))
    order = [*[quoted(k) for k in keys], F.col(path), F.col(row)]
    sketch = placed.select(*order).orderBy(F.xxhash64(path, row), path, row).limit(SKETCH_PER_RANGE * ranges)
    met = sketch.orderBy(*order).collect()
    kinds = [placed.schema[k].dataType for k in [*keys, path, row]]
    cuts = sorted({len(met) * i // ranges for i in range(1, ranges)} - {0})
    bounds = [[F.lit(value).cast(kind) for value, kind in zip(met[cut], kinds, strict=True)] for cut in cuts]
    ranged = placed.withColumn(number, _range_of(order, bounds))
    sizes = dict(ranged.groupBy(number).count().collect())
    before = list(accumulate((sizes.get(i, 0) for i in range(len(bounds))), initial=start - 1))
    place = F.row_number().over(Window.partitionBy(number).orderBy(*order))
    shift = F.element_at(F.array(*[F.lit(n).cast("bigint") for n in before]), F.col(number) + 1)
    numbered = ranged.withColumn(row, place.cast("bigint") + shift)
    return numbered.select(*_in_place(frame, name, F.col(row)))


def _bounded_ranges(frame: DataFrame, keys: Sequence[str], ranges: int | None) -> int | None:
    """As many ranges as ``_by_bounds`` should make, if it can: rows straight from Parquet files, keys whose values can
    be literals, and few enough ranges for a plan."""
    if not is_plain_scan(frame, "row_index") or not all(isinstance(frame.schema[k].dataType, LITERAL_KEYS) for k in keys):
        return None
    wanted = ranges or _ranges(frame) or int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return wanted if wanted <= MOST_BOUNDS else None


def dense_row_id(
    frame: DataFrame,
    keys: Sequence[str],
    name: str = "row_id",
    start: int = 1,
    num_partitions: int | None = None,
    location: str | None = None,
) -> DataFrame:
    """Ids ``start``, ``start + 1``, ... in the order of ``keys``, without a single-task window.

    Rows are range-partitioned by ``keys``, sorted within partitions and written once (to ``location``, or to the
    shared scratch folder). A row's id is its position in its file plus the rows of the files before it, so lost
    executors cannot change it. Runs of equal keys are split between tasks by each row's place in the input, and numbered
    in that order. A column already called ``name`` is numbered anew in its place, else the ids come last.
    ``num_partitions`` sets the number of key ranges; for a frame that is not a plain scan it defaults to the shuffle
    partitions of the session.

    Rows straight from Parquet files, in up to ``MOST_BOUNDS`` ranges, are numbered without the write, unless a
    ``location`` is asked for; see ``_by_bounds``. Their equal keys are numbered by path and place in the file.
    """
    few = None if location else _bounded_ranges(frame, keys, num_partitions)
    if few is not None:
        return _by_bounds(frame, keys, name, start, few)
    spark = frame.sparkSession
    order = [quoted(k) for k in keys]
    location = location or scratch_dir(spark, "rowid") + "/rows"
    origin, file, shift, row = (fresh_name(frame, taken) for taken in ("origin", "file", "shift", "row"))
    tied = frame.withColumn(origin, F.monotonically_increasing_id())
    bounds = [*order, F.col(origin)]
    ranges = num_partitions or _ranges(frame)
    ranged = tied.repartitionByRange(*bounds) if ranges is None else tied.repartitionByRange(ranges, *bounds)
    ranged.sortWithinPartitions(*bounds).drop(origin).write.parquet(location)

    written = spark.read.schema(frame.schema).parquet(location)
    file_name = F.col("_metadata.file_name")
    sizes = written.groupBy(file_name.alias(file)).count().collect()
    shifts, total = [], start
    for name_of_file, rows in sorted(sizes, key=lambda size: part_order(size[0])):
        shifts.append((name_of_file, total))
        total += rows
    before = spark.createDataFrame(shifts, T.StructType([T.StructField(file, T.StringType()), T.StructField(shift, T.LongType())]))
    if len(shifts) <= BROADCAST_FILES:
        before = F.broadcast(before)
    placed = written.select("*", file_name.alias(file), F.col("_metadata.row_index").alias(row))
    return placed.join(before, file).select(*_in_place(frame, name, F.col(shift) + F.col(row)))
