"""File-system access through the Hadoop ``FileSystem`` API, so any path scheme Spark reads works here too."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

from pyspark.sql import SparkSession

from tableprep.errors import READ_FILE_CODE, ReadError, TablePrepError, guard


@dataclass(frozen=True)
class Entry:
    """One child of a directory."""

    path: str
    name: str
    is_dir: bool
    length: int


def hadoop_path(spark: SparkSession, path: str):
    """``(FileSystem, Path)`` for ``path``."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def is_directory(spark: SparkSession, path: str) -> bool:
    fs, hadoop = hadoop_path(spark, path)
    return fs.exists(hadoop) and fs.getFileStatus(hadoop).isDirectory()


def iter_children(spark: SparkSession, path: str) -> Iterator[Entry]:
    """Files and directories directly under ``path`` as the listing delivers them; ``_`` and ``.`` names are skipped."""
    with guard(ReadError, f"cannot list {path}", READ_FILE_CODE):
        fs, hadoop = hadoop_path(spark, path)
        statuses = fs.listStatusIterator(hadoop)
        while statuses.hasNext():
            status = statuses.next()
            child = status.getPath()
            if child.getName()[0] not in "_.":
                yield Entry(child.toString(), child.getName(), status.isDirectory(), status.getLen())


def list_children(spark: SparkSession, path: str) -> list[Entry]:
    """All children, sorted by name."""
    return sorted(iter_children(spark, path), key=lambda e: e.name)


def part_order(name: str) -> tuple[int, str]:
    """Sort key of ``part-…`` file names: by task number, then by name. Numbers may outgrow their zero padding."""
    number = re.match(r"part-(?:r-)?(\d+)", name)
    return (int(number.group(1)) if number else -1, name)


def rename(spark: SparkSession, source: str, target: str) -> bool:
    fs, hadoop = hadoop_path(spark, source)
    return fs.rename(hadoop, spark._jvm.org.apache.hadoop.fs.Path(target))


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = hadoop_path(spark, path)
    return fs.exists(hadoop)


def delete(spark: SparkSession, path: str) -> None:
    """Drop a file, or a directory with all it holds; nothing happens where there is none."""
    fs, hadoop = hadoop_path(spark, path)
    fs.delete(hadoop, True)


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A small new file, written by the driver."""
    fs, hadoop = hadoop_path(spark, path)
    stream = fs.create(hadoop, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


_handed_out: dict[str, list[str]] = {}


@cache
def _local_base(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"run-{application}-")


def scratch_base(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of the machine: executors elsewhere could not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise TablePrepError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_base(spark.sparkContext.applicationId)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh directory in the shared folder, dropped by ``clear_scratch`` or when the application ends."""
    path = f"{scratch_base(spark)}/tableprep-{label}-{uuid.uuid4().hex}"
    fs, hadoop = hadoop_path(spark, path)
    fs.mkdirs(hadoop)
    fs.deleteOnExit(hadoop)
    _handed_out.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear_scratch(spark: SparkSession) -> None:
    """Drop all scratch data of this application. Frames that still read it fail afterwards."""
    for path in _handed_out.pop(spark.sparkContext.applicationId, []):
        fs, hadoop = hadoop_path(spark, path)
        fs.delete(hadoop, True)
