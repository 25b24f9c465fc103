"""Checking and cleaning column names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tableprep.functions.fixed import NON_RESERVED_KEYWORDS, RESERVED_KEYWORDS


def common_prefix(names: Sequence[str]) -> str:
    """The longest ``xxx.`` shared by all of at least two names, or an empty string."""
    if len(names) < 2:
        return ""
    low, high = min(names), max(names)
    shared = 0
    while shared < min(len(low), len(high)) and low[shared] == high[shared]:
        shared += 1
    return low[: low.rfind(".", 0, shared) + 1]


def stripped_prefix(frame: DataFrame) -> str:
    """What ``strip_common_prefix`` takes off the names of ``frame``; an empty string if it leaves them as they are."""
    prefix = common_prefix(frame.columns)
    return "" if prefix in frame.columns else prefix


def strip_common_prefix(frame: DataFrame) -> DataFrame:
    """Drop the prefix all column names share, up to its last dot; names without one stay as they are, and so do all
    when a name would be left empty. ``stripped_prefix`` tells which it is."""
    prefix = stripped_prefix(frame)
    return frame.toDF(*[name[len(prefix):] for name in frame.columns]) if prefix else frame


def is_reserved(name: Column) -> Column:
    return F.upper(name).isin(RESERVED_KEYWORDS)


def is_forbidden(name: Column) -> Column:
    """Reserved, or a keyword that is better not used as a name."""
    return F.upper(name).isin(sorted({*NON_RESERVED_KEYWORDS, *RESERVED_KEYWORDS}))


def reserved_word_names(names: DataFrame, column: str) -> DataFrame:
    """``names`` with ``is_reserved`` and ``is_forbidden`` for the names in ``column``; set lookups, no join."""
    name = F.col(column)
    return names.select("*", is_reserved(name).alias("is_reserved"), is_forbidden(name).alias("is_forbidden"))


def reserved_word_columns(frame: DataFrame) -> DataFrame:
    """(column, is_reserved, is_forbidden) for the columns of ``frame``."""
    names = frame.sparkSession.createDataFrame([(c,) for c in frame.columns], "column string")
    return reserved_word_names(names, "column")


def safe_column_names(frame: DataFrame, suffix: str = "_") -> DataFrame:
    """``frame`` with ``suffix`` added to every column named like a keyword, more than once if the name is taken."""
    words = {*NON_RESERVED_KEYWORDS, *RESERVED_KEYWORDS}
    taken, names = {c.lower() for c in frame.columns}, []
    for name in frame.columns:
        if name.upper() in words:
            name += suffix
            while name.lower() in taken:
                name += suffix
            taken.add(name.lower())
        names.append(name)
    return frame.toDF(*names)
