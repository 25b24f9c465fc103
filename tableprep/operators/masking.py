"""Masking sensitive values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tableprep.functions.columns import quoted
from tableprep.functions.fixed import MASK

# A name holding one of the first, and not the last, marks a sensitive value.
SENSITIVE = ("password", "access_key")
HARMLESS = "passwordfid"


def name_is_sensitive(name: str) -> bool:
    lowered = name.strip().lower()
    return any(word in lowered for word in SENSITIVE) and HARMLESS not in lowered


def is_sensitive(name: Column) -> Column:
    lowered = F.lower(F.trim(name))
    return (lowered.contains(SENSITIVE[0]) | lowered.contains(SENSITIVE[1])) & ~lowered.contains(HARMLESS)


def mask_columns(frame: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Every column with a sensitive name, and those listed in ``extra``, becomes a mask; masked data is not read."""
    listed = {name.lower() for name in extra or []}
    return frame.select(
        *[
            (F.lit(MASK) if name_is_sensitive(c) or c.lower() in listed else quoted(c)).alias(c) for c in frame.columns
        ]
    )


def mask_sensitive(settings: DataFrame, key: str, value: str) -> DataFrame:
    """Key and value rows with the values of sensitive keys masked."""
    masked = F.when(is_sensitive(quoted(key)), F.lit(MASK)).otherwise(quoted(value).cast("string"))
    return settings.withColumn(value, masked)
