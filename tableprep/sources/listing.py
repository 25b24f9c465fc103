"""Listings: files, databases and the tables of a directory."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tableprep.errors import READ_FILE_CODE, VIEW_FROM_PARQUET_CODE, EmptyInputError, ReadError, SchemaError, guard
from tableprep.storage import hadoop_path, is_directory, iter_children, list_children

LISTINGS_AT_ONCE = 16
#: What stands for null in the name of a partition directory.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
FILE_COLUMNS = ("path", "modificationTime", "length")


def file_catalog(spark: SparkSession, directory: str, glob: str | None = None, recursive: bool = False) -> DataFrame:
    """(path, modificationTime, length) of the files under ``directory``; their content is never read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    with guard(ReadError, f"cannot list {directory}", READ_FILE_CODE):
        found = reader.load(directory).select(*FILE_COLUMNS)
        if recursive or any(c in directory for c in "*?[{"):
            return found
        fs, hadoop = hadoop_path(spark, directory)
        whole = fs.makeQualified(hadoop).toString()
    # Spark also lists the files of partitions such as k=v; only those right here are asked for
    parent = F.regexp_replace(F.regexp_replace("path", r"/[^/]*$", ""), r"^([A-Za-z0-9]+):/+", "$1:/")
    here = re.sub(r"^([A-Za-z0-9]+):/+", r"\1:/", whole).rstrip("/")
    return found.where((parent == here) | (F.col("path").endswith("/" + here.rsplit("/", 1)[-1])))


def file_catalog_recursive(spark: SparkSession, directory: str, glob: str | None = None) -> DataFrame:
    """As ``file_catalog``, at any depth."""
    return file_catalog(spark, directory, glob, recursive=True)


def directory_entries(spark: SparkSession, directory: str) -> DataFrame:
    """(path, name, is_dir, length) of the files and directories directly under ``directory``."""
    rows = [(e.path, e.name, e.is_dir, e.length) for e in list_children(spark, directory)]
    return spark.createDataFrame(rows, "path string, name string, is_dir boolean, length bigint")


def list_databases(spark: SparkSession) -> DataFrame:
    """(namespace, only_default): ``only_default`` hints that the session points at a warehouse of its own making."""
    databases = spark.sql("SHOW DATABASES")
    only_default = databases.count() == 1
    return databases.withColumn("only_default", F.lit(only_default))


@dataclass(frozen=True)
class FoundTable:
    """A table: what to read, and the folder below which the names of directories are values of partition columns."""

    paths: tuple[str, ...]
    base: str | None = None

    @property
    def label(self) -> str:
        """One path, or pattern, for all of it."""
        if self.base is None or len(self.paths) == 1 and self.paths[0] == self.base:
            return self.paths[0]
        folder, name = self.paths[0].rsplit("/", 1)
        return f"{folder}/{name.partition('=')[0]}=*"


def partition_value(directory: str) -> tuple[str, str] | None:
    """(name, value as written) of a directory called ``name=value``, else None."""
    name, sign, value = directory.partition("=")
    return (unescape_path_name(name), unescape_path_name(value)) if sign and name and value else None


def find_tables(spark: SparkSession, path: str) -> list[FoundTable]:
    """The tables under ``path``: child directories and, beside them, files of any name; ``path`` itself when it holds
    files alone. Directories called ``name=value`` are no tables of their own but together one that is partitioned by
    ``name``, apart for each name."""
    directories, files, partitions = [], [], {}
    for entry in iter_children(spark, path):
        value = partition_value(entry.name) if entry.is_dir else None
        if value is not None:
            partitions.setdefault(value[0], []).append(entry.path)
        else:
            (directories if entry.is_dir else files).append(entry.path)
    if not (directories or files or partitions):
        raise EmptyInputError(f"no tables under {path}", VIEW_FROM_PARQUET_CODE)
    if not directories and not partitions:
        return [FoundTable((path,))]
    if len(partitions) == 1 and not directories and not files:
        return [FoundTable((path,), path)]
    found = [FoundTable((p,)) for p in directories + files]
    found += [FoundTable(tuple(sorted(paths)), path) for paths in partitions.values()]
    return sorted(found, key=lambda table: table.label)


def with_base(spark: SparkSession, table: FoundTable) -> FoundTable:
    """``table``, marked as partitioned if it is one folder that holds ``name=value`` directories."""
    if table.base is None and is_directory(spark, table.paths[0]):
        if any(e.is_dir and partition_value(e.name) for e in iter_children(spark, table.paths[0])):
            return FoundTable(table.paths, table.paths[0])
    return table


def discover_tables(spark: SparkSession, path: str) -> list[str]:
    """Paths of the tables under ``path``, as ``find_tables`` tells them; a table partitioned by ``y`` that shares its
    folder with others is ``<path>/y=*``."""
    return [table.label for table in find_tables(spark, path)]


def partition_columns(spark: SparkSession, table: FoundTable) -> dict[str, set[str | None]]:
    """The partition columns of a table, outermost first, with all their values as written (None where there is none).
    Directories are listed level by level, several at a time; files are not."""
    base = (table.base or "").rstrip("/")
    level = [p for p in table.paths if p.rstrip("/") != base] or [
        e.path for e in iter_children(spark, base) if e.is_dir and partition_value(e.name)]
    values: dict[str, set[str | None]] = {}
    with ThreadPoolExecutor(LISTINGS_AT_ONCE) as pool:
        while level:
            seen: dict[str, set[str | None]] = {}
            for directory in level:
                name, value = partition_value(directory.rstrip("/").rsplit("/", 1)[-1])
                seen.setdefault(name, set()).add(None if value == NO_VALUE else value)
            if len(seen) > 1 or set(seen) & set(values):
                raise SchemaError(f"{base} is partitioned by {', '.join([*values, *seen])} at one depth or twice")
            values.update(seen)
            children = pool.map(lambda d: [e.path for e in iter_children(spark, d) if e.is_dir and partition_value(e.name)], level)
            level = [path for paths in children for path in paths]
    return values


def unescape_path_name(name: str) -> str:
    """Characters that Spark and Hive write as ``%XX`` in the names of partition directories."""
    return re.sub("%([0-9A-Fa-f]{2})", lambda found: chr(int(found[1], 16)), name)
