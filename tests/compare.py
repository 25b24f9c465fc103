"""Side-by-side run of a registered query and its SQL."""

from __future__ import annotations

import decimal
import math

import duckdb

from querybook.book import TABLES


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, decimal.Decimal):
        return str(value)
    return value


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return connection


SAME = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz", "DATE": "date", "FLOAT": "float", "SMALLINT": "smallint", '"NULL"': "string",
}


def mismatch(frame, connection, sql):
    """None when both sides agree, else what differs."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    expected = sorted_rows(names, result.fetchall())
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} but expected {sorted(names)}"
    for field in frame.schema.fields:
        want = types[field.name]
        if SAME.get(want, want.lower().replace(" ", "")) != field.dataType.simpleString():
            return f"type of {field.name}: {field.dataType.simpleString()} but expected {want}"
    actual = sorted_rows(frame.columns, [tuple(r) for r in frame.collect()])
    if len(actual) != len(expected):
        return f"{len(actual)} rows but expected {len(expected)}"
    for have, want in zip(actual, expected, strict=True):
        if have != want:
            return f"row {have} but expected {want}"
    return None
