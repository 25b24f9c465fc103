"""Queries for schema reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from querybook.book import query, table
from querybook.family import DEFAULTS, ERAS_SQL, order_eras
from tableprep.operators.reconcile import drift_report as report_drift
from tableprep.operators.reconcile import observe, resolved_union_paths
from tableprep.operators.reconcile import resolve_types as types_for
from tableprep.operators.reconcile import resolved_union as union_resolved
from tableprep.operators.views import schema_report
from tableprep.plans.projection import union_all as bag_union
from tableprep.sinks.writers import write_parquet
from tableprep.sources.readers import read_parquet_instances as read_instances
from tableprep.storage import list_children, rename, scratch_dir


@query(f"select * from ({ERAS_SQL})")
def resolved_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_resolved(order_eras(spark, sf_dir), DEFAULTS, tag_column="era")


FILLED_SQL = f"""
    select 0 as ordinal, 'o_orderkey' as col, 'bigint' as resolved, 'bigint' as observed, false as drifted,
           count(o_orderkey) as n_filled from ({ERAS_SQL})
    union all select 1, 'o_custkey', 'bigint', 'bigint', false, count(o_custkey) from ({ERAS_SQL})
    union all select 2, 'order_year', 'bigint', 'smallint,int,bigint', true, count(order_year) from ({ERAS_SQL})
    union all select 3, 'o_totalprice', 'double', 'float,double', true, count(o_totalprice) from ({ERAS_SQL})
    union all select 4, 'code', 'string', 'int,string', true, count(code) from ({ERAS_SQL})
    union all select 5, 'region_tag', 'string', 'string', false, count(region_tag) from ({ERAS_SQL})
    union all select 6, 'o_orderstatus', 'string', 'string', false, count(o_orderstatus) from ({ERAS_SQL})
    union all select 7, 'o_orderpriority', 'string', 'string', false, count(o_orderpriority) from ({ERAS_SQL})
"""


@query(f"select col, resolved, n_filled from ({FILLED_SQL})")
def resolve_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The types found for the family, checked against the data cast to them."""
    eras = order_eras(spark, sf_dir)
    resolved = types_for(observe([f.schema for _, f in eras], DEFAULTS))
    united = union_resolved(eras, DEFAULTS).to(resolved)
    return schema_report(united, filled_counts=True).select(
        F.col("column").alias("col"), F.col("type").alias("resolved"), "n_filled"
    )


@query(FILLED_SQL)
def drift_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observed and resolved types of the family with the values each column ends up with."""
    eras = order_eras(spark, sf_dir)
    drift = report_drift(spark, observe([f.schema for _, f in eras], DEFAULTS))
    filled = schema_report(union_resolved(eras, DEFAULTS), filled_counts=True).select("ordinal", "n_filled")
    return drift.join(filled, "ordinal").select(
        "ordinal", F.col("column").alias("col"), "resolved", F.concat_ws(",", "observed").alias("observed"), "drifted",
        "n_filled",
    )


@query("""
    select event_id, user_id, case when event_type = 'click' then null else value end as value from events
""")
def typed_null_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    is_click = F.col("event_type").eqNullSafe("click")
    return union_resolved(
        [
            events.where(is_click).select("event_id", "user_id"),
            events.where(~is_click).select("event_id", "user_id", "value"),
        ]
    )


@query("""
    select c_custkey, case when c_acctbal < 0 then 'it''s' else nullif(c_mktsegment, 'BUILDING') end as c_mktsegment,
           5 as n
    from customer
""")
def default_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Defaults fill absent columns only: nulls of a present column stay null."""
    customer = table(spark, sf_dir, "customer")
    in_debt = F.coalesce(F.col("c_acctbal") < 0, F.lit(False))
    segment = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("c_mktsegment")
    return union_resolved(
        [customer.where(in_debt).select("c_custkey"), customer.where(~in_debt).select("c_custkey", segment)],
        {"c_mktsegment": "it's", "n": 5},
    )


@query("select *, year(o_orderdate)::varchar as source_year from orders")
def source_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table per year, read in one scan, tagged from the paths of its files."""
    location = scratch_dir(spark, "yearly")
    orders = table(spark, sf_dir, "orders").withColumn("y", F.year("o_orderdate"))
    orders.write.mode("overwrite").partitionBy("y").parquet(location)
    tagged = resolved_union_paths(spark, [location], tag_column="source_year", tag_pattern=r"/y=(\d{4})/")
    return tagged.drop("y")  # the same year, as the directory names give it


@query("select o_orderkey as k from orders union all select l_orderkey as k from lineitem")
def union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lineitem = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    return bag_union(
        [orders.select(F.col("o_orderkey").alias("k")), lineitem.select(F.col("l_orderkey").alias("k"))]
    )


@query(f"select * from ({ERAS_SQL})")
def discover_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drifting family written as directories, found again by listing."""
    location = scratch_dir(spark, "eras")
    for number, (era, frame) in enumerate(order_eras(spark, sf_dir)):
        write_parquet(frame, f"{location}/{number}_{era}")
    return resolved_union_paths(
        spark, [location], DEFAULTS, tag_column="era", tag_pattern=r"/\d_([^/]+)/[^/]+$", view_name="order_family"
    )


@query("""
    select o_orderkey, o_totalprice, case when year(o_orderdate) <> 1999 then year(o_orderdate) end::bigint as y,
           case when year(o_orderdate) <> 1999 then lpad(month(o_orderdate)::varchar, 2, '0') end as m
    from orders
""")
def discover_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One root with the years before 1999 in directories y=.../m=01, 1999 in a file without a suffix beside them, and the
    rest in a plain directory whose rows hold their year and month."""
    location = scratch_dir(spark, "layouts")
    year, month = F.year("o_orderdate"), F.lpad(F.month("o_orderdate").cast("string"), 2, "0")
    orders = table(spark, sf_dir, "orders")
    dated = orders.select("o_orderkey", "o_totalprice", year.alias("y"), month.alias("m"))
    dated.where("y < 1999").write.partitionBy("y", "m").parquet(f"{location}/root")
    dated.where("y > 1999").withColumn("y", F.col("y").cast("bigint")).write.parquet(f"{location}/root/later")
    dated.where("y = 1999").select("o_orderkey", "o_totalprice").coalesce(1).write.parquet(f"{location}/one")
    part = next(e for e in list_children(spark, f"{location}/one") if not e.is_dir)
    rename(spark, part.path, f"{location}/root/000000_0")
    return resolved_union_paths(spark, [f"{location}/root"])


@query("""
    select l_orderkey, l_linenumber::bigint as l_linenumber, l_quantity,
           case when l_returnflag = 'R' then null else l_linestatus end as l_linestatus
    from lineitem
""")
def read_parquet_instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Widening drift and an absent column, left to one scan."""
    lineitem = table(spark, sf_dir, "lineitem")
    location = scratch_dir(spark, "instances")
    returned = F.col("l_returnflag").eqNullSafe("R")
    old = lineitem.where(returned).select(
        "l_orderkey", F.col("l_linenumber").cast("smallint").alias("l_linenumber"),
        F.col("l_quantity").cast("float").alias("l_quantity"),
    )
    new = lineitem.where(~returned).select(
        "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_quantity", "l_linestatus"
    )
    write_parquet(old, f"{location}/old")
    write_parquet(new, f"{location}/new")
    schema = types_for(observe([old.schema, new.schema]))
    return read_instances(spark, f"{location}/old", f"{location}/new", schema=schema)
