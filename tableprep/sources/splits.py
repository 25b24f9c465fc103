"""What each split of text files holds, so that many tasks can share one file and still know where they stand in it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from tableprep.functions.columns import source_path
from tableprep.storage import scratch_dir

BROADCAST_SPLITS = 100_000

def earlier() -> WindowSpec:
    """The splits before one in its file, in order."""
    return Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)


def placed(lines: DataFrame) -> DataFrame:
    """``lines`` with their ``file``, its ``path`` as the scan spells it, the ``start`` of their split and their ``place``,
    which grows within a split."""
    return lines.select(
        "*", source_path().alias("file"), F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("place"))


def kept_small(splits: DataFrame, label: str) -> DataFrame:
    """One row for each split, written once; broadcast to the lines if there are few."""
    path = scratch_dir(splits.sparkSession, label) + "/splits"
    splits.write.parquet(path)
    read = splits.sparkSession.read.schema(splits.schema).parquet(path)
    return F.broadcast(read) if read.count() <= BROADCAST_SPLITS else read


def number_lines(lines: DataFrame) -> DataFrame:
    """(file, line_no, value): the number of each line in its file, from 1.

    One narrow scan counts the lines of each split; their running sums are a few rows. A line's number is the sum
    before its split plus its place in it, so no text is shuffled, sorted or written. That the splits are the same in both
    scans is checked for every line: reading under other split settings than at the call is an error, not a wrong
    number."""
    found = placed(lines.select("value"))
    splits = found.groupBy("path", "start").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    known = kept_small(splits.select("*", F.coalesce(F.sum("n").over(earlier()), F.lit(0)).alias("before")), "lines")
    position = F.col("place") - F.col("first")
    moved: Column = F.raise_error(F.lit("files or split settings changed since the lines were counted")).cast("bigint")
    number = F.when((position >= 0) & (position < F.col("n")), F.col("before") + position + 1).otherwise(moved)
    return found.join(known, ["path", "start"], "left").select("file", number.alias("line_no"), "value")
