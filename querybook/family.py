"""The orders table as a drifting family of three eras that together hold every order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from querybook.book import table

SECOND_ERA = "1997-01-01"
THIRD_ERA = "1999-01-01"


def order_eras(spark: SparkSession, sf_dir: str) -> list[tuple[str, DataFrame]]:
    """Year widens from smallint to bigint, price from float to double, code turns to text, columns come and go, and
    the spelling of one name changes."""
    orders = table(spark, sf_dir, "orders")
    day = F.col("o_orderdate")
    second, third = F.lit(SECOND_ERA).cast("timestamp_ntz"), F.lit(THIRD_ERA).cast("timestamp_ntz")
    year, month = F.year(day), F.month(day)
    early = orders.where(day < second).select(
        "o_orderkey", "o_custkey", year.cast("smallint").alias("order_year"),
        F.col("o_totalprice").cast("float").alias("o_totalprice"), month.alias("code"),
    )
    middle = orders.where((day >= second) & (day < third)).select(
        "o_orderkey", "o_custkey", year.alias("order_year"), "o_totalprice",
        F.concat(F.lit("M"), month.cast("string")).alias("code"), "o_orderstatus",
    )
    late = orders.where(day >= third).select(
        "o_orderkey", "o_custkey", year.cast("bigint").alias("order_year"), "o_totalprice",
        F.concat(F.lit("L"), month.cast("string")).alias("code"), F.col("o_orderstatus").alias("O_OrderStatus"),
        "o_orderpriority",
    )
    return [("early", early), ("middle", middle), ("late", late)]


DEFAULTS = {"region_tag": "EU"}

ERAS_SQL = f"""
    select o_orderkey, o_custkey, year(o_orderdate)::bigint as order_year, o_totalprice::float::double as o_totalprice,
           month(o_orderdate)::varchar as code, 'EU' as region_tag, null::varchar as o_orderstatus,
           null::varchar as o_orderpriority, 'early' as era
    from orders where o_orderdate < timestamp '{SECOND_ERA}'
    union all
    select o_orderkey, o_custkey, year(o_orderdate)::bigint, o_totalprice, 'M' || month(o_orderdate), 'EU',
           o_orderstatus, null, 'middle'
    from orders where o_orderdate >= timestamp '{SECOND_ERA}' and o_orderdate < timestamp '{THIRD_ERA}'
    union all
    select o_orderkey, o_custkey, year(o_orderdate)::bigint, o_totalprice, 'L' || month(o_orderdate), 'EU',
           o_orderstatus, o_orderpriority, 'late'
    from orders where o_orderdate >= timestamp '{THIRD_ERA}'
"""
