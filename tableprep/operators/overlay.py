"""Layered tables: the highest layer that has a value wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tableprep.functions.columns import quoted, typed_null
from tableprep.functions.types import resolve_type
from tableprep.plans.projection import by_lower_name, union_all


def _best(value: Column, rank: Column, data_type: T.DataType) -> Column:
    """The non-null value of highest rank. Equal ranks go to the greater value, so that every run agrees."""
    if "map<" in data_type.simpleString():  # maps have no order
        return F.max_by(value, F.when(value.isNotNull(), rank))
    pair = F.struct(rank.alias("rank"), value.alias("value"))
    return F.max(F.when(value.isNotNull(), pair)).getField("value")


def layered_overlay(settings: DataFrame, key: str, value: str, precedence: Sequence[str]) -> DataFrame:
    """(key, value) with the value of the highest ``precedence``; values that are null fall through.

    A maximum per key, combined before the shuffle, so a key with very many rows costs no more than others.
    """
    rank = F.struct(*[quoted(c) for c in precedence])
    best = _best(quoted(value), rank, settings.schema[value].dataType)
    return settings.groupBy(quoted(key)).agg(best.alias(value))


def overlay_tables(layers: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Tables laid over each other by ``keys``, the first on top; a null lets the value below show through.

    One shuffle however many layers there are: rows are ranked, put in one bag and the best value of each column is
    taken per key. Columns and keys whose types differ between layers get the type that holds them all.
    """
    seen: dict[str, list[T.StructField]] = {}
    for layer in layers:
        for name, field in by_lower_name(layer.schema).items():
            seen.setdefault(name, []).append(field)
    fields = {name: T.StructField(found[0].name, resolve_type([f.dataType for f in found])) for name, found in seen.items()}
    lowered = {k.lower() for k in keys}
    values = [f for name, f in fields.items() if name not in lowered]
    rank_name = "rank"
    while rank_name in fields:
        rank_name += "_"

    def ranked(layer: DataFrame, rank: int) -> DataFrame:
        present = by_lower_name(layer.schema)

        def value(field: T.StructField) -> Column:
            found = present.get(field.name.lower())
            return typed_null(field.dataType) if found is None else quoted(found.name).cast(field.dataType)

        return layer.select(
            *[value(fields[k.lower()]).alias(k) for k in keys], *[value(f).alias(f.name) for f in values],
            F.lit(rank).alias(rank_name),
        )

    bag = union_all([ranked(layer, len(layers) - i) for i, layer in enumerate(layers)])
    best = [_best(quoted(f.name), F.col(rank_name), f.dataType).alias(f.name) for f in values]
    return bag.groupBy(*[quoted(k) for k in keys]).agg(*best)
