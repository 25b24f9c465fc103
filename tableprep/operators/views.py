"""Views and previews."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tableprep.errors import VIEW_FROM_PARQUET_CODE
from tableprep.functions.columns import cell_text, cut_text, quoted
from tableprep.functions.types import ATOMIC
from tableprep.sources.readers import read_parquet


def view_from_parquet(spark: SparkSession, path: str, view_name: str) -> DataFrame:
    """Register a Parquet scan as a view. No job runs; preview it with ``show_string`` where wanted."""
    frame = read_parquet(spark, path, code=VIEW_FROM_PARQUET_CODE)
    frame.createOrReplaceTempView(view_name)
    return frame


def preview(frame: DataFrame, rows: int = 20, width: int = 20, order_by: list[str] | None = None) -> DataFrame:
    """The first ``rows`` rows as cut text cells. With ``order_by`` the rows are the same on every run."""
    ordered = frame.orderBy(*[quoted(c) for c in order_by]) if order_by else frame
    return ordered.limit(max(rows, 0)).select(
        *[cut_text(cell_text(quoted(f.name), f.dataType), width).alias(f.name) for f in frame.schema.fields]
    )


def show_string(frame: DataFrame, rows: int = 20, width: int = 20, order_by: list[str] | None = None) -> str:
    """A fixed-width grid of the first rows. Headers are never cut; columns are at least three wide."""
    rows = max(rows, 0)
    taken = preview(frame, rows + 1, width, order_by).collect()
    names, cells = frame.columns, [list(r) for r in taken[:rows]]
    widths = [max([3, len(name), *(len(r[i]) for r in cells)]) for i, name in enumerate(names)]
    align = str.rjust if width > 0 else str.ljust
    rule = "+" + "+".join("-" * w for w in widths) + "+"
    lines = ["|" + "|".join(align(c, w) for c, w in zip(r, widths, strict=True)) + "|" for r in [names, *cells]]
    grid = [rule, lines[0], rule, *lines[1:], rule]
    if len(taken) > rows:
        grid.append(f"only showing top {rows} {'row' if rows == 1 else 'rows'}")
    return "\n" + "\n".join(grid) + "\n"


def schema_report(frame: DataFrame, filled_counts: bool = False) -> DataFrame:
    """(ordinal, column, type, supported), one row per column; ``supported`` marks the plain atomic types.

    ``filled_counts`` adds the rows of the table and the non-null values of each column, from a single aggregate.
    """
    facts = [
        (i, f.name, f.dataType.simpleString(), isinstance(f.dataType, ATOMIC))
        for i, f in enumerate(frame.schema.fields)
    ]
    if not filled_counts:
        return frame.sparkSession.createDataFrame(
            facts, "ordinal int, column string, type string, supported boolean"
        )
    counted = frame.agg(
        F.count("*").alias("rows"), F.array(*[F.count(quoted(c)) for c in frame.columns]).alias("filled")
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("ordinal"), F.lit(name).alias("column"), F.lit(kind).alias("type"),
                F.lit(ok).alias("supported"), F.col("rows").alias("n_rows"),
                F.element_at("filled", i + 1).alias("n_filled"),
            )
            for i, name, kind, ok in facts
        ]
    )
    return counted.select(F.inline(rows))


