"""SQL text as jobs. Spark's own parser and optimizer do the work."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tableprep.errors import DEFAULT_CODE, READ_FILE_CODE, SQL_CODE, EmptyInputError, ReadError, SqlError, guard
from tableprep.operators.views import show_string
from tableprep.sources.readers import read_text


def sql_query(
    spark: SparkSession,
    text: str,
    tables: Mapping[str, DataFrame] | None = None,
    args: Mapping[str, object] | None = None,
    code: int = DEFAULT_CODE,
) -> DataFrame:
    """Run ``text`` over the registered views, and over ``tables``, which are registered while it is analysed; the
    caller's views of the same names are back afterwards."""
    own = {view.name.lower() for view in spark.catalog.listTables() if view.isTemporary} if tables else set()
    before = {name: spark.table(name) for name in tables or {} if name.lower() in own}
    try:
        for name, frame in (tables or {}).items():
            frame.createOrReplaceTempView(name)
        with guard(SqlError, f"failed executing SQL: {text}", code):
            return spark.sql(text, args=dict(args)) if args else spark.sql(text)
    finally:
        for name in tables or {}:
            if name in before:
                before[name].createOrReplaceTempView(name)
            else:
                spark.catalog.dropTempView(name)


def sql_file_job(
    spark: SparkSession,
    path: str,
    tables: Mapping[str, DataFrame] | None = None,
    args: Mapping[str, object] | None = None,
    preview_rows: int = 0,
) -> DataFrame:
    """Run the SQL text in the file at ``path``; with ``preview_rows`` also print the first rows under its name."""
    files = read_text(spark, path, code=READ_FILE_CODE, wholetext=True).take(2)
    if not files or not files[0][0].strip():
        raise EmptyInputError(f"{path} is empty", READ_FILE_CODE)
    if len(files) > 1:
        raise ReadError(f"{path} holds more than one file; name the one to run", READ_FILE_CODE)
    result = sql_query(spark, files[0][0], tables, args, SQL_CODE)
    if preview_rows:
        print(path.rsplit("/", 1)[-1] + show_string(result, preview_rows))
    return result
