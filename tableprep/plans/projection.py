"""One projection builder for every operator that lines a frame up with a target schema."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tableprep.errors import SchemaError
from tableprep.functions.columns import quoted, typed_null


def by_lower_name(schema: T.StructType) -> dict[str, T.StructField]:
    """Fields by lower-cased name; names that differ only in case cannot be told apart."""
    fields: dict[str, T.StructField] = {}
    for field in schema.fields:
        if field.name.lower() in fields:
            raise SchemaError(f"column {field.name!r} appears twice")
        fields[field.name.lower()] = field
    return fields


def aligned(
    frame: DataFrame,
    target: T.StructType,
    defaults: Mapping[str, object] | None = None,
    replaced: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``frame`` with exactly the columns, order and types of ``target``.

    A present column is cast only when its type differs, so filters on unchanged columns still reach the scan. An
    absent one becomes its default, or a typed null. ``replaced`` overrides columns outright. Map keys are lower-case.
    """
    present = by_lower_name(frame.schema)
    defaults, replaced = defaults or {}, replaced or {}

    def column(field: T.StructField) -> Column:
        key = field.name.lower()
        if key in replaced:
            return replaced[key].cast(field.dataType)
        if key not in present:
            return F.lit(defaults[key]).cast(field.dataType) if key in defaults else typed_null(field.dataType)
        source = present[key]
        value = quoted(source.name)
        same = source.dataType.simpleString() == field.dataType.simpleString()
        return value if same else value.cast(field.dataType)

    return frame.select(*[column(f).alias(f.name) for f in target.fields])


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Bag union of frames that already share one projection; duplicates stay.

    Halves are joined first: Spark analyses every intermediate union anew, which a long chain would make quadratic.
    """
    if len(frames) == 1:
        return frames[0]
    middle = len(frames) // 2
    return union_all(frames[:middle]).union(union_all(frames[middle:]))
