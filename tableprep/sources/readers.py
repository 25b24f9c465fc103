"""Guarded readers. Each returns a lazy DataFrame and fails with a typed error at analysis time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tableprep.errors import DEFAULT_CODE, READ_FILE_CODE, EmptyInputError, ReadError, guard
from tableprep.functions.columns import quoted
from tableprep.plans.projection import union_all
from tableprep.sources import quoted as quoted_csv
from tableprep.sources.splits import number_lines
from tableprep.storage import scratch_dir


def _read(
    spark: SparkSession, fmt: str, paths: tuple[str, ...], schema: T.StructType | str | None, code: int,
    options: dict[str, object],
) -> DataFrame:
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    with guard(ReadError, f"cannot read {fmt} from {', '.join(paths)}", code):
        return reader.load(list(paths))


def read_parquet(
    spark: SparkSession, *paths: str, schema: T.StructType | str | None = None, code: int = DEFAULT_CODE,
    **options: object,
) -> DataFrame:
    return _read(spark, "parquet", paths, schema, code, options)


def read_orc(
    spark: SparkSession, *paths: str, schema: T.StructType | str | None = None, code: int = DEFAULT_CODE,
    **options: object,
) -> DataFrame:
    return _read(spark, "orc", paths, schema, code, options)


def read_csv(
    spark: SparkSession, *paths: str, schema: T.StructType | str | None = None, code: int = DEFAULT_CODE,
    **options: object,
) -> DataFrame:
    """Without options: no header row and string columns ``_c0``, ``_c1`` and so on."""
    return _read(spark, "csv", paths, schema, code, options)


def read_text(spark: SparkSession, *paths: str, code: int = DEFAULT_CODE, **options: object) -> DataFrame:
    return _read(spark, "text", paths, None, code, options)


def read_parquet_instances(
    spark: SparkSession, *paths: str, schema: T.StructType | str, code: int = DEFAULT_CODE
) -> DataFrame:
    """Several instances of one table in a single scan under an agreed schema.

    The reader widens integers and reals and fills absent columns with null; other drift needs ``resolved_union``.
    """
    return read_parquet(spark, *paths, schema=schema, code=code, recursiveFileLookup=True)


def read_header_csv(spark: SparkSession, *paths: str, header: bool = True, code: int = READ_FILE_CODE) -> DataFrame:
    """CSV with quoted fields and line breaks inside quotes; all columns are strings.

    When the last row of a file is blank in every field it is dropped; blank rows elsewhere stay. A file whose header
    names other columns, or the same in another order, is an error when it is read. Line breaks are ``\\n`` or ``\\r\\n``.

    Every file is shared by as many tasks as it has splits. The call surveys the quotes once. Files whose records are all one
    line are then left to Spark's reader, which filters and columns reach; only others have their records put
    together, see ``quoted``. Files with bare carriage returns, and files with line breaks inside quotes in folders
    named after values, are read by one task each.
    """
    options = {"header": header, "quote": '"', "escape": '"', "enforceSchema": False}
    names = read_csv(spark, *paths, code=code, multiLine=True, **options).columns
    with guard(ReadError, f"cannot read csv from {', '.join(paths)}", code):
        inside = spark.read.text(list(paths)).columns[1:]
        splits = quoted_csv.survey(spark, list(paths))
        location = scratch_dir(spark, "quotes") + "/survey"
        splits.write.parquet(location)
        splits = spark.read.schema(splits.schema).parquet(location)
        files = quoted_csv.kinds_of_files(splits)
        kinds = {row.kind for row in files.select("kind").distinct().collect()}
    if kinds <= {quoted_csv.PLAIN}:
        return read_csv(spark, *paths, code=code, **options)
    if inside:
        return _read_whole(spark, paths, code, options, len(inside))
    of_kind: dict[int, list[str]] = {}
    for row in files.collect():
        of_kind.setdefault(row.kind, []).append(row.file)
    parts = []
    if quoted_csv.PLAIN in of_kind:
        schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
        parts.append(read_csv(spark, *of_kind[quoted_csv.PLAIN], schema=schema, code=code, **options))
    if quoted_csv.QUOTED in of_kind:
        parts.append(quoted_csv.read_quoted(spark, of_kind[quoted_csv.QUOTED], splits, names, header))
    if quoted_csv.WHOLE in of_kind:
        parts.append(_read_whole(spark, of_kind[quoted_csv.WHOLE], code, options))
    return union_all(parts)


def _read_whole(
    spark: SparkSession, paths: Sequence[str], code: int, options: dict[str, object], in_paths: int = 0
) -> DataFrame:
    """Each file by one task from start to end; the last ``in_paths`` columns come from the names of folders.

    A blank row is held back until the next row of its file shows that it was not the last: one pass, no shuffle, at most
    one row held."""
    rows = read_csv(spark, *paths, code=code, multiLine=True, **options)
    names = rows.columns
    blank = F.lit(True)
    for name in names[:len(names) - in_paths]:
        blank = blank & F.coalesce(quoted(name) == F.lit(""), F.lit(True))

    def without_blank_ends(batches):
        import numpy as np
        import pyarrow.compute as pc

        held = None
        for batch in batches:
            size = batch.num_rows
            if size == 0:
                continue
            files, is_blank = batch.column(len(names)), batch.column(len(names) + 1).to_numpy(zero_copy_only=False)
            if held is not None and held.column(len(names))[0] == files[0]:
                yield held.select(names)
            changes = pc.not_equal(files.slice(1), files.slice(0, size - 1)).to_numpy(zero_copy_only=False)
            ends = np.append(changes.astype(bool), True)
            dropped = is_blank.astype(bool) & ends
            held = batch.slice(size - 1, 1) if dropped[-1] else None
            yield batch.select(names).take(np.flatnonzero(~dropped))

    marked = rows.select("*", F.col("_metadata.file_path").alias("__file"), blank.alias("__blank"))
    return marked.mapInArrow(without_blank_ends, rows.schema)


def read_lines(spark: SparkSession, *paths: str, numbered: bool = False, code: int = READ_FILE_CODE) -> DataFrame:
    """Lines of text files; input without a single line is an error.

    ``numbered`` adds ``file`` and a 1-based ``line_no`` within it, whatever number of tasks share one huge file; see
    ``number_lines``.
    """
    lines = read_text(spark, *paths, code=code)
    with guard(ReadError, f"cannot read lines of {', '.join(paths)}", code):
        if lines.isEmpty():
            raise EmptyInputError(f"{', '.join(paths)} is empty", code)
    if not numbered:
        return lines
    return number_lines(lines)
