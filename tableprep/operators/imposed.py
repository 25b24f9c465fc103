"""Imposing a declared schema on the instances of a table. Columns and rules are data, never code."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tableprep.errors import SchemaError, guard
from tableprep.functions.columns import not_blank, null_to_code, offset_key, quoted, round_money, typed_null
from tableprep.functions.fixed import MONEY_COMMENT
from tableprep.operators.reconcile import observe, resolve_types, scans_by_layout
from tableprep.operators.rowid import surrogate_id
from tableprep.plans.projection import aligned, by_lower_name, union_all
from tableprep.sinks.writers import write_gzip_intermediate
from tableprep.sources.readers import read_parquet


@dataclass(frozen=True)
class KeyOffset:
    """Rename a key and move it by ``offset``."""

    name: str
    offset: int = 10**14


@dataclass(frozen=True)
class ImposedRules:
    """Column rules, first match wins: key offset, money, date, null code, then a plain cast."""

    key_offsets: Mapping[str, KeyOffset] = field(default_factory=dict)
    money_comment: str | None = MONEY_COMMENT
    money_type: T.DataType | None = None
    date_type: T.DataType | None = T.TimestampNTZType()
    null_codes: Mapping[str, str] = field(default_factory=dict)
    required_key: str | None = None


def column_list(columns: str | Sequence[str]) -> list[str]:
    """Trimmed names of a comma list; an empty name is an error."""
    names = [c.strip() for c in (columns.split(",") if isinstance(columns, str) else columns)]
    if not all(names):
        raise SchemaError(f"empty column name in {columns!r}")
    return names


def lookup_schema(registry: DataFrame, table: str, dataset: str) -> T.StructType:
    """Declared schema of (table, dataset), whatever their case.

    ``registry`` has (table_name, dataset, ordinal, column_name, data_type, comment), one row per declared column.
    """
    matching = (F.lower("table_name") == table.lower()) & (F.lower("dataset") == dataset.lower())
    declared = registry.where(matching).orderBy("ordinal").select("column_name", "data_type", "comment").collect()
    if not declared:
        raise SchemaError(f"no declared schema for table {table!r}, dataset {dataset!r}")
    schema = T.StructType()
    for name, data_type, comment in declared:
        schema.add(name, T.DataType.fromDDL(data_type), True, {"comment": comment} if comment else None)
    return schema


def select_columns_ci(frames: Sequence[DataFrame], columns: str | Sequence[str]) -> DataFrame:
    """The listed columns of every frame, found whatever their case, under resolved types; absent ones are null."""
    resolved = by_lower_name(resolve_types(observe([f.schema for f in frames])))
    target = T.StructType(
        [
            T.StructField(name, resolved[name.lower()].dataType if name.lower() in resolved else T.StringType())
            for name in column_list(columns)
        ]
    )
    return union_all([aligned(f, target) for f in frames])


def _imposed_column(
    name: str, declared: T.StructField, source: T.StructField | None, rules: ImposedRules
) -> Column:
    key = name.lower()
    offsets = {k.lower(): v for k, v in rules.key_offsets.items()}
    codes = {k.lower(): v for k, v in rules.null_codes.items()}
    value = None if source is None else quoted(source.name)
    is_money = rules.money_comment is not None and declared.metadata.get("comment") == rules.money_comment
    is_date = rules.date_type is not None and isinstance(declared.dataType, T.DateType)
    if key in offsets:
        rule = offsets[key]
        return (typed_null(T.LongType()) if value is None else offset_key(value, rule.offset)).alias(rule.name)
    if is_money:
        money_type = rules.money_type or declared.dataType
        if value is None:
            return typed_null(money_type).alias(name)
        if rules.money_type is None:
            value = round_money(value if source.dataType == money_type else value.try_cast(money_type))
        else:
            value = round_money(value, money_type)
        return value.cast(money_type).alias(name)  # rounding changes the precision of a decimal
    if is_date:
        return (typed_null(rules.date_type) if value is None else value.try_cast(rules.date_type)).alias(name)
    if key in codes:
        return (F.lit(codes[key]) if value is None else null_to_code(value, codes[key])).alias(name)
    if value is None:
        return typed_null(declared.dataType).alias(name)
    return (value if source.dataType == declared.dataType else value.try_cast(declared.dataType)).alias(name)


def imposed_union(
    frames: Sequence[DataFrame], columns: str | Sequence[str], schema: T.StructType, rules: ImposedRules | None = None
) -> DataFrame:
    """Union of ``frames`` reduced to ``columns`` with the types and rules declared for them.

    Values that do not fit their declared type become null. Rows with a blank ``required_key`` are dropped before the
    projection, in a form that reaches the file scan.
    """
    if not frames:
        raise SchemaError("no tables to impose a schema on")
    rules = rules or ImposedRules()
    declared = by_lower_name(schema)
    names = column_list(columns)
    unknown = [n for n in names if n.lower() not in declared]
    if unknown:
        raise SchemaError(f"no declared type for {', '.join(unknown)}")
    branches = []
    for frame in frames:
        present = by_lower_name(frame.schema)
        if rules.required_key is not None:
            if rules.required_key.lower() not in present:
                raise SchemaError(f"required key {rules.required_key!r} is absent from a table")
            key = present[rules.required_key.lower()]
            frame = frame.where(not_blank(quoted(key.name), key.dataType))
        with guard(SchemaError, "the declared types do not fit a table"):
            branches.append(
                frame.select(*[_imposed_column(n, declared[n.lower()], present.get(n.lower()), rules) for n in names])
            )
    return union_all(branches)


def imposed_union_paths(
    spark: SparkSession,
    paths: Sequence[str],
    columns: str | Sequence[str],
    schema: T.StructType | None = None,
    rules: ImposedRules | None = None,
    id_name: str | None = None,
    id_offset: int = 0,
    view_name: str | None = None,
    stored_for: str | None = None,
) -> DataFrame:
    """Discover the tables under ``paths`` and reduce them to ``columns`` under the declared ``schema``.

    Without a schema the types are resolved from the tables. ``id_name`` puts unique ids in front. With ``stored_for``, a
    raw path, the result is written as gzip Parquet beside it (see ``write_gzip_intermediate``) and read from there; it
    is an error if something is stored there already. The result is registered as ``view_name``. One scan per
    distinct schema, not per table.
    """
    frames = scans_by_layout(spark, paths)
    if schema is None:
        result = select_columns_ci(frames, columns)
    else:
        result = imposed_union(frames, columns, schema, rules)
    if id_name is not None:
        result = surrogate_id(result, id_name, id_offset)
    if stored_for is not None:
        result = read_parquet(spark, write_gzip_intermediate(result, stored_for), schema=result.schema)
    if view_name is not None:
        result.createOrReplaceTempView(view_name)
    return result
