"""Reconciling table families whose columns and types drifted over time."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tableprep.errors import VIEW_FROM_PARQUET_CODE, SchemaError
from tableprep.functions.columns import source_path
from tableprep.functions.types import distinct_types, reader_widens, resolve_type, type_of_default, type_of_text
from tableprep.operators.rowid import dense_row_id
from tableprep.plans.projection import aligned, by_lower_name, union_all
from tableprep.sources.listing import FoundTable, find_tables, partition_columns, with_base
from tableprep.sources.readers import read_parquet

LEAF_DIRECTORY = r"([^/]+)/[^/]+$"

Frames = Sequence[DataFrame | tuple[str, DataFrame]]


@dataclass(frozen=True)
class ObservedColumn:
    """A column in first-seen spelling with every type seen for it, in first-seen order."""

    name: str
    types: tuple[T.DataType, ...]


def observe(schemas: Sequence[T.StructType], defaults: Mapping[str, object] | None = None) -> list[ObservedColumn]:
    """Columns in first-seen order. Names match whatever their case. Defaults vote after the first table."""
    names: dict[str, str] = {}
    types: dict[str, list[T.DataType]] = {}

    def see(name: str, data_type: T.DataType) -> None:
        names.setdefault(name.lower(), name)
        types.setdefault(name.lower(), []).append(data_type)

    for position, schema in enumerate(schemas):
        for field in by_lower_name(schema).values():
            see(field.name, field.dataType)
        if position == 0:
            for name, value in (defaults or {}).items():
                see(name, type_of_default(value))
    return [ObservedColumn(names[key], tuple(distinct_types(types[key]))) for key in names]


def resolve_types(observed: Sequence[ObservedColumn], mixed_numeric: str = "string") -> T.StructType:
    """One target type per observed column."""
    fields = []
    for column in observed:
        try:
            fields.append(T.StructField(column.name, resolve_type(column.types, mixed_numeric)))
        except SchemaError as cause:
            raise SchemaError(f"column {column.name!r}: {cause}") from cause
    return T.StructType(fields)


def drift_report(
    spark: SparkSession, observed: Sequence[ObservedColumn], mixed_numeric: str = "string"
) -> DataFrame:
    """(ordinal, column, resolved, observed, drifted), one row per column in first-seen order."""
    resolved = resolve_types(observed, mixed_numeric)
    rows = [
        (i, c.name, f.dataType.simpleString(), [t.simpleString() for t in c.types], len(c.types) > 1)
        for i, (c, f) in enumerate(zip(observed, resolved.fields, strict=True))
    ]
    return spark.createDataFrame(
        rows, "ordinal int, column string, resolved string, observed array<string>, drifted boolean"
    )


def _with_tag_field(schema: T.StructType, tag_column: str | None) -> T.StructType:
    """The tag is a string; it keeps the place of an existing column of that name, else it comes last."""
    if tag_column is None:
        return schema
    fields = [
        T.StructField(f.name, T.StringType()) if f.name.lower() == tag_column.lower() else f for f in schema.fields
    ]
    if tag_column.lower() not in by_lower_name(schema):
        fields.append(T.StructField(tag_column, T.StringType()))
    return T.StructType(fields)


def _lowered(defaults: Mapping[str, object] | None) -> dict[str, object]:
    return {name.lower(): value for name, value in (defaults or {}).items()}


def resolved_union(
    frames: Frames,
    defaults: Mapping[str, object] | None = None,
    tag_column: str | None = None,
    mixed_numeric: str = "string",
) -> DataFrame:
    """Union of drifting frames under one resolved schema. Lazy, narrow, one branch per frame.

    ``defaults`` fill columns a frame lacks; nulls in columns it has stay. ``tag_column`` receives the tag of each
    ``(tag, frame)`` pair.
    """
    if not frames:
        raise SchemaError("no tables to reconcile")
    pairs = [f if isinstance(f, tuple) else (None, f) for f in frames]
    target = resolve_types(observe([f.schema for _, f in pairs], defaults), mixed_numeric)
    target = _with_tag_field(target, tag_column)
    fill = _lowered(defaults)
    return union_all(
        [
            aligned(frame, target, fill, {} if tag_column is None else {tag_column.lower(): F.lit(tag)})
            for tag, frame in pairs
        ]
    )


@dataclass(frozen=True)
class TableInstance:
    """One discovered table, and the columns of its footers and of the names of its directories."""

    table: FoundTable
    schema: T.StructType

    @property
    def partitioned(self) -> bool:
        return self.table.base is not None


def open_instances(spark: SparkSession, paths: Sequence[str], parallelism: int = 16) -> list[TableInstance]:
    """Every table under ``paths`` in listing order. Only footers are read, several tables at a time.

    Partition columns stand behind the others and get the type that holds all their values, which is a number or date
    only where each would be written that way again: months ``01`` to ``12`` stay text."""

    def open_one(found: FoundTable) -> TableInstance:
        table = with_base(spark, found)
        below = {} if table.base is None else {"recursiveFileLookup": True}
        schema = read_parquet(spark, *table.paths, code=VIEW_FROM_PARQUET_CODE, **below).schema
        if table.base is None:
            return TableInstance(table, schema)
        values = partition_columns(spark, table)
        fields = {name: T.StructField(name, _type_of_values(seen)) for name, seen in values.items()}
        lowered = {name.lower() for name in fields}
        kept = [field for field in schema.fields if field.name.lower() not in lowered]
        return TableInstance(table, T.StructType([*kept, *fields.values()]))

    tables = [table for path in paths for table in find_tables(spark, path)]
    with ThreadPoolExecutor(parallelism) as pool:
        return list(pool.map(open_one, tables))


def _type_of_values(values: Collection[str | None]) -> T.DataType:
    known = [type_of_text(value) for value in sorted(v for v in values if v is not None)]
    return resolve_type(known) if known else T.StringType()


def _scan_groups(
    instances: Sequence[TableInstance], target: T.StructType, defaults: Mapping[str, object]
) -> list[tuple[T.StructType, list[TableInstance]]]:
    """Instances that one multi-path scan can read together, with the schema to read them under.

    The Parquet reader widens integers and reals and fills absent columns with null by itself, so drift of that kind
    needs a single scan however many tables there are. Otherwise tables of equal schema share a scan. Names must be
    spelled alike for either, since a case-sensitive session would not find them in the files.
    """
    resolved = by_lower_name(target)
    missing_default = any(name not in by_lower_name(i.schema) for i in instances for name in defaults)
    widening = all(
        reader_widens(f.dataType, resolved[f.name.lower()].dataType) for i in instances for f in i.schema.fields
    )
    one_spelling = all(f.name == resolved[f.name.lower()].name for i in instances for f in i.schema.fields)
    if widening and one_spelling and not missing_default and not any(i.partitioned for i in instances):
        return [(target, list(instances))]
    return _equal_layouts(instances)


def _equal_layouts(instances: Sequence[TableInstance]) -> list[tuple[T.StructType, list[TableInstance]]]:
    """Instances of equal schema together; those partitioned on disk stay apart, as their roots differ."""
    groups: dict[object, tuple[T.StructType, list[TableInstance]]] = {}
    for number, instance in enumerate(instances):
        layout = tuple((f.name, f.dataType.simpleString()) for f in instance.schema.fields)
        key = number if instance.partitioned else layout
        groups.setdefault(key, (instance.schema, []))[1].append(instance)
    return list(groups.values())


def _scan(spark: SparkSession, schema: T.StructType, group: Sequence[TableInstance]) -> DataFrame:
    paths = [path for instance in group for path in instance.table.paths]
    base = {} if group[0].table.base is None else {"basePath": group[0].table.base}
    return read_parquet(spark, *paths, schema=schema, code=VIEW_FROM_PARQUET_CODE, **base)


def scans_by_layout(spark: SparkSession, paths: Sequence[str]) -> list[DataFrame]:
    """The tables under ``paths``, one frame per distinct schema."""
    return [_scan(spark, schema, group) for schema, group in _equal_layouts(open_instances(spark, paths))]


def source_tag(pattern: str = LEAF_DIRECTORY) -> Column:
    """Part of the path of the file a row was read from; by default the directory holding the file."""
    return F.regexp_extract(source_path(), pattern, 1)


def resolved_union_paths(
    spark: SparkSession,
    paths: Sequence[str],
    defaults: Mapping[str, object] | None = None,
    tag_column: str | None = None,
    tag_pattern: str = LEAF_DIRECTORY,
    mixed_numeric: str = "string",
    view_name: str | None = None,
    numbered: tuple[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Discover the tables under ``paths`` and union them under one resolved schema, registered as ``view_name``.

    ``numbered``, a column and the keys it follows, numbers the rows of the union anew, 1, 2, 3 … (``dense_row_id``).
    Tables may be laid out differently: what is a directory name in one may be a column in another. The
    plan has one scan per distinct schema, not one per table, so thousands of daily tables stay plannable.
    """
    instances = open_instances(spark, paths)
    target = resolve_types(observe([i.schema for i in instances], defaults), mixed_numeric)
    fill = _lowered(defaults)
    tagged = _with_tag_field(target, tag_column)
    replaced = {} if tag_column is None else {tag_column.lower(): source_tag(tag_pattern)}
    groups = _scan_groups(instances, target, fill)
    result = union_all([aligned(_scan(spark, schema, group), tagged, fill, replaced) for schema, group in groups])
    if numbered is not None:
        result = dense_row_id(result, numbered[1], numbered[0])
    if view_name is not None:
        result.createOrReplaceTempView(view_name)
    return result
