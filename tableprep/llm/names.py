"""Column names for what operators add to a caller's frame."""

from __future__ import annotations

from pyspark.sql import DataFrame


def fresh(frame: DataFrame, name: str) -> str:
    """``name``, with as many underscores behind it as make it new; Spark ignores case in names."""
    taken = {column.lower() for column in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name
