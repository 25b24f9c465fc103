"""Readable names for the files of a written table."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from tableprep.errors import EmptyInputError, WriteError
from tableprep.sinks.writers import ERROR, write_parquet
from tableprep.sources.listing import file_catalog
from tableprep.storage import delete, exists, list_children, part_order, put_text, rename

RENAMES_AT_ONCE = 16
#: Names and sizes of the files of a published folder; readers pass it over.
MANIFEST = "_manifest"


def range_name(table: str, number: int, files: int, extension: str) -> str:
    """``<table>-<number>in0to<files - 1><extension>``, numbers of equal width, or ``<table>-single<extension>``."""
    if files == 1:
        return f"{table}-single{extension}".lower()
    width = len(str(files - 1))
    return f"{table}-{number:0{width}d}in{0:0{width}d}to{files - 1}{extension}".lower()


def rename_parts(spark: SparkSession, path: str, table: str | None = None) -> list[str]:
    """Rename the ``part-…`` files directly under ``path``, in task order; returns the new names. They begin with
    ``table``, by default the name of the folder.

    Only file names change case, never directories. Metadata calls only; no data moves on a real file system.
    """
    listed = file_catalog(spark, path, "part-*").select("path").collect()
    parts = sorted((tuple(r.path.rsplit("/", 1)) for r in listed), key=lambda part: part_order(part[1]))
    if not parts:
        raise EmptyInputError(f"no part files under {path}")
    table = table or path.rstrip("/").rsplit("/", 1)[-1]

    def rename_one(number: int) -> str:
        folder, part = parts[number]
        last = part.rsplit("-", 1)[-1]
        name = range_name(table, number, len(parts), last[last.index("."):] if "." in last else "")
        if not rename(spark, f"{folder}/{part}", f"{folder}/{name}"):
            raise WriteError(f"cannot rename {folder}/{part} to {name}")
        return name

    with ThreadPoolExecutor(RENAMES_AT_ONCE) as pool:
        return list(pool.map(rename_one, range(len(parts))))


def _publish(spark: SparkSession, staging: str, path: str, replace: bool) -> None:
    """``staging`` becomes ``path`` by one directory rename. What stood there moves aside first and comes back if the
    rename fails; it is dropped when the new table is in place."""
    old = f"{staging}-old"
    moved = replace and exists(spark, path)
    if moved and not rename(spark, path, old):
        raise WriteError(f"cannot move {path} aside")
    if exists(spark, path) or not rename(spark, staging, path):
        if moved:
            rename(spark, old, path)
        raise WriteError(f"cannot publish {path}")
    if moved:
        delete(spark, old)


def write_range_named(frame: DataFrame, path: str, files: int | None = None, mode: str = ERROR) -> list[str]:
    """Write Parquet, in ``files`` files when given, under readable names; returns the names. Names count the files of
    the whole folder, so nothing can be appended to one.

    Files are written and renamed in a hidden folder beside ``path``, and a list of them with their sizes, ``_manifest``, is
    added. Then one rename publishes the folder, so readers see the old table or the new one, and a failure before
    that leaves the old one whole. Where a rename is a copy, as in object stores, that last step is not one moment.
    """
    if mode == "append":
        raise WriteError(f"cannot append to {path}: its file names count all files")
    spark = frame.sparkSession
    path = path.rstrip("/")
    if exists(spark, path) and mode != "overwrite":
        if mode == "ignore":
            return []
        raise WriteError(f"{path} exists")
    folder, _, table = path.rpartition("/")
    staging = f"{folder}/_{table}-{uuid.uuid4().hex}"
    try:
        write_parquet(frame if files is None else frame.repartition(files), staging)
        names = rename_parts(spark, staging, table)
        sizes = {entry.name: entry.length for entry in list_children(spark, staging)}
        put_text(spark, f"{staging}/{MANIFEST}", "".join(f"{name}\t{sizes[name]}\n" for name in names))
        _publish(spark, staging, path, mode == "overwrite")
    except BaseException:
        delete(spark, staging)
        raise
    return names
