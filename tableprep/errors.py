"""Typed errors. Every error carries the numeric code callers may use as an exit status."""

from __future__ import annotations

from contextlib import contextmanager

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException

DEFAULT_CODE = 1
VIEW_FROM_PARQUET_CODE = 150
SQL_CODE = 151
WRITE_FILE_CODE = 303
READ_FILE_CODE = 304


class TablePrepError(Exception):
    """Base class; ``code`` identifies the failing step."""

    def __init__(self, message: str, code: int = DEFAULT_CODE):
        super().__init__(message)
        self.code = code


class ReadError(TablePrepError):
    """A source could not be opened."""


class EmptyInputError(ReadError):
    """A source exists but holds nothing to work on."""


class WriteError(TablePrepError):
    """A sink failed."""


class SqlError(TablePrepError):
    """SQL text was rejected; the message includes the text."""


class SchemaError(TablePrepError):
    """Columns or types cannot be reconciled."""


@contextmanager
def guard(error: type[TablePrepError], what: str, code: int = DEFAULT_CODE):
    """Turn Spark failures inside the block into ``error`` with ``code``.

    Reads and SQL are lazy, so they are guarded at analysis time; writes run inside the block.
    """
    try:
        yield
    except (PySparkException, Py4JError) as cause:
        raise error(f"{what}: {cause}", code) from cause
