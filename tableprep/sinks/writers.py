"""Guarded writers. Writing is an action, so the guard covers execution too."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from tableprep.errors import DEFAULT_CODE, WRITE_FILE_CODE, WriteError, guard
from tableprep.functions.columns import quoted

ERROR = "errorifexists"


def _write(frame: DataFrame, fmt: str, path: str, mode: str, code: int, options: dict[str, object]) -> None:
    with guard(WriteError, f"cannot write {fmt} to {path}", code):
        frame.write.format(fmt).mode(mode).options(**options).save(path)


def write_parquet(frame: DataFrame, path: str, mode: str = ERROR, code: int = DEFAULT_CODE, **options: object) -> None:
    _write(frame, "parquet", path, mode, code, options)


def write_orc(frame: DataFrame, path: str, mode: str = ERROR, code: int = DEFAULT_CODE, **options: object) -> None:
    _write(frame, "orc", path, mode, code, options)


def write_csv(frame: DataFrame, path: str, mode: str = ERROR, code: int = DEFAULT_CODE, **options: object) -> None:
    _write(frame, "csv", path, mode, code, options)


def write_text(frame: DataFrame, path: str, mode: str = ERROR, code: int = DEFAULT_CODE, **options: object) -> None:
    """``frame`` has a single string column."""
    _write(frame, "text", path, mode, code, options)


def intermediate_path(table_path: str) -> str:
    """Where the gzip copy of a raw table goes: the same place under ``/intermediate/``, with a suffix."""
    return table_path.rstrip("/").replace("/raw/", "/intermediate/") + "_nppk"


def write_gzip_intermediate(frame: DataFrame, raw_path: str, mode: str = ERROR, code: int = DEFAULT_CODE) -> str:
    """Write gzip Parquet beside the raw table it was made from; returns the path."""
    path = intermediate_path(raw_path)
    write_parquet(frame, path, mode, code, compression="gzip")
    return path


def write_text_blob(spark: SparkSession, body: str | DataFrame, path: str, mode: str = ERROR) -> None:
    """One string to one UTF-8 file in the folder ``path``; the file ends with a line break.

    ``body`` may be a one-row frame, so the text need not pass through the driver.
    """
    row = body if isinstance(body, DataFrame) else spark.createDataFrame([(body,)], "value string")
    text = F.regexp_replace(quoted(row.columns[0]), r"\n\z", "").alias("value")
    write_text(row.select(text).coalesce(1), path, mode, WRITE_FILE_CODE, lineSep="\n")


def prefixed_name(prefix: str, table: str) -> str:
    """``table`` with ``prefix`` in front; an underscore is added when the prefix lacks one."""
    return f"{prefix}{'' if not prefix or prefix.endswith('_') else '_'}{table}"


def save_prefixed_table(
    frame: DataFrame, table: str, prefix: str = "", mode: str = ERROR, path: str | None = None, fmt: str = "parquet"
) -> str:
    """Save as a catalog table under its prefixed name, at ``path`` when given; returns the name."""
    name = prefixed_name(prefix, table)
    writer = frame.write.format(fmt).mode(mode)
    with guard(WriteError, f"cannot save table {name}"):
        (writer if path is None else writer.option("path", path)).saveAsTable(name)
    return name


def partitioned_sink(
    frame: DataFrame, path: str, by: Sequence[str], fmt: str = "parquet", mode: str = ERROR, rebalance: bool = True,
    **options: object,
) -> None:
    """Write one directory per value of ``by``, Parquet or ORC.

    ``rebalance`` brings rows of one value together so that each directory gets few files; adaptive execution splits
    values with very many rows over several tasks. Without it nothing is shuffled and every task writes to every
    value it meets.
    """
    rows = frame.hint("rebalance", *[quoted(c) for c in by]) if rebalance else frame
    with guard(WriteError, f"cannot write {fmt} to {path}"):
        rows.write.format(fmt).mode(mode).options(**options).partitionBy(*by).save(path)
