"""Loading only what is new."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tableprep.errors import WriteError, guard
from tableprep.functions.columns import fresh_name, quoted
from tableprep.storage import is_directory


def high_water_mark(target: DataFrame, key: str) -> object:
    """The highest key already loaded, or None. One value reaches the driver."""
    return target.agg(F.max(quoted(key))).first()[0]


def _mark(target: DataFrame, key: str) -> Column | None:
    """The highest key already loaded, as a literal. Times travel as microseconds, since a clock time may come twice."""
    zoned = isinstance(target.schema[key].dataType, T.TimestampType)
    mark = target.agg(F.unix_micros(F.max(quoted(key))) if zoned else F.max(quoted(key))).first()[0]
    return None if mark is None else F.timestamp_micros(F.lit(mark)) if zoned else F.lit(mark)


def incremental_load(
    source: DataFrame, target: DataFrame, key: str, ids: Sequence[str] = (), overlap: object = None
) -> DataFrame:
    """Rows of ``source`` whose ``key`` exceeds every key in ``target``; all rows when ``target`` is empty.

    The mark is a literal in the plan, so it reaches the file scan and whole row groups are skipped.

    With ``ids``, the columns that tell rows apart, rows that come late are loaded too, once: those whose key equals the
    mark, or lies up to ``overlap`` (a number, or a ``timedelta`` for dates and times) before it, and whose ids no
    row of ``target`` in that window has; null ids are equal. Only the window is read of ``target`` and compared. Rows
    whose key is null are not loaded while ``target`` has a key.
    """
    mark = _mark(target, key)
    if mark is None:
        return source
    kind, column = source.schema[key].dataType, quoted(key)
    new = source.where(column > mark.cast(kind))
    if not ids:
        return new
    low = mark if overlap is None else mark - F.lit(overlap)
    known = [fresh_name(source, f"known_{i}") for i in range(len(ids))]
    loaded = target.where(column >= low.cast(target.schema[key].dataType)).select(
        *[quoted(name).alias(alias) for name, alias in zip(ids, known, strict=True)])
    same = F.lit(True)
    for name, alias in zip(ids, known, strict=True):
        same = same & quoted(name).eqNullSafe(quoted(alias))
    late = source.where((column >= low.cast(kind)) & (column <= mark.cast(kind))).join(loaded, same, "left_anti")
    return new.union(late)


def incremental_stream(
    spark: SparkSession, path: str, schema: T.StructType, target: str, checkpoint: str, fmt: str = "parquet",
    files_per_batch: int | None = None,
) -> None:
    """Append the files of ``path`` not loaded by earlier runs to ``target``, then stop.

    ``checkpoint`` remembers the loaded files, so each file is appended exactly once however often this runs.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if not is_directory(spark, path):
        path, _, name = path.rpartition("/")
        reader = reader.option("pathGlobFilter", name)
    with guard(WriteError, f"cannot load {path} into {target}"):
        query = (
            reader.load(path).writeStream.format("parquet").option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start(target)
        )
        query.awaitTermination()
