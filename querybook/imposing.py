"""Queries for imposed schemas and row ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from querybook.book import query, table
from querybook.family import ERAS_SQL, order_eras
from tableprep.functions.columns import not_blank
from tableprep.functions.columns import null_to_code as code_for_null
from tableprep.functions.columns import offset_key as key_with_offset
from tableprep.functions.columns import round_money as money
from tableprep.functions.fixed import MONEY_COMMENT
from tableprep.operators.imposed import ImposedRules, KeyOffset
from tableprep.operators.imposed import imposed_union as union_imposed
from tableprep.operators.imposed import imposed_union_paths as union_imposed_paths
from tableprep.operators.imposed import lookup_schema as declared_schema
from tableprep.operators.imposed import select_columns_ci as columns_of
from tableprep.operators.profile import row_count as count_rows
from tableprep.operators.profile import value_counts as frequencies
from tableprep.operators.rowid import dense_row_id as number_rows
from tableprep.operators.rowid import reproducible_id as with_reproducible_id
from tableprep.operators.rowid import surrogate_id as with_surrogate_id
from tableprep.sinks.writers import write_parquet
from tableprep.storage import scratch_dir

MONEY = T.DecimalType(18, 2)

KEY_SQL = """case when o_custkey % 7 = 0 then '' when o_custkey % 11 = 0 then null
    when o_custkey % 13 = 0 then 'X' || o_custkey else o_custkey::varchar end"""


def built_key() -> Column:
    """Customer keys as text, some blank, some null, some not numeric."""
    key = F.col("o_custkey")
    return (
        F.when(key % 7 == 0, "").when(key % 11 == 0, None)
        .when(key % 13 == 0, F.concat(F.lit("X"), key.cast("string"))).otherwise(key.cast("string"))
    )


IMPOSED_SQL = f"""
    select try_cast(k as bigint) + 100000000000000 as person_id, o_orderkey,
           o_totalprice::decimal(18, 2) as o_totalprice, case when o_orderdate < timestamp '1998-01-01'
           then o_orderdate::date::timestamp end as day,
           case when o_orderdate < timestamp '1998-01-01' then coalesce(nullif(o_orderstatus, 'P'), '9') else '9' end
           as code
    from (select *, {KEY_SQL} as k from orders)
    where k is not null and k <> ''
"""

IMPOSED_COLUMNS = "cust_key, o_orderkey, o_totalprice, day, code"
IMPOSED_RULES = ImposedRules(
    key_offsets={"cust_key": KeyOffset("person_id")}, money_type=MONEY, null_codes={"code": "9"}, required_key="cust_key"
)


def imposed_schema() -> T.StructType:
    return (
        T.StructType().add("cust_key", "string").add("o_orderkey", "long")
        .add("o_totalprice", "double", True, {"comment": MONEY_COMMENT}).add("day", "date").add("code", "string")
    )


def keyed_orders(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Two instances of orders, the later one without day and code and with other spellings."""
    orders = table(spark, sf_dir, "orders")
    day = F.col("o_orderdate")
    turn = F.lit("1998-01-01").cast("timestamp_ntz")
    old = orders.where(day < turn).select(
        built_key().alias("cust_key"), "o_orderkey", "o_totalprice", day.cast("date").alias("day"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("code"),
    )
    new = orders.where(day >= turn).select(
        built_key().alias("CUST_KEY"), "o_orderkey", F.col("o_totalprice").alias("O_TotalPrice")
    )
    return [old, new]


@query(IMPOSED_SQL)
def imposed_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_imposed(keyed_orders(spark, sf_dir), IMPOSED_COLUMNS, imposed_schema(), IMPOSED_RULES)


@query(IMPOSED_SQL)
def imposed_union_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The instances on disk, found by listing and turned into a view with ids; ids themselves cannot be compared."""
    location = scratch_dir(spark, "imposed")
    for number, frame in enumerate(keyed_orders(spark, sf_dir)):
        write_parquet(frame, f"{location}/{number}")
    union_imposed_paths(
        spark, [location], IMPOSED_COLUMNS, imposed_schema(), IMPOSED_RULES, "seqnum", 10**12, "keyed_orders"
    )
    return spark.table("keyed_orders").drop("seqnum")


@query(f"""
    select code as "CODE", o_orderkey as "o_ORDERKEY", order_year, null::varchar as missing from ({ERAS_SQL})
""")
def select_columns_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns_of([f for _, f in order_eras(spark, sf_dir)], " CODE, o_ORDERKEY , order_year,missing")


@query("""
    select l_orderkey, l_linenumber::bigint as l_linenumber, l_quantity::int as l_quantity,
           l_shipdate::date::timestamp as l_shipdate
    from lineitem
""")
def lookup_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The schema declared for (table, dataset), found whatever the case, imposed on the whole table."""
    registry = spark.createDataFrame(
        [
            ("LineItem", "Multi_Year", 1, "l_orderkey", "bigint", None),
            ("LineItem", "Multi_Year", 2, "l_linenumber", "bigint", None),
            ("LineItem", "Multi_Year", 3, "l_quantity", "int", "whole pieces"),
            ("LineItem", "Multi_Year", 4, "l_shipdate", "date", None),
            ("LineItem", "Sample", 1, "l_orderkey", "string", None),
        ],
        "table_name string, dataset string, ordinal int, column_name string, data_type string, comment string",
    )
    schema = declared_schema(registry, "lineitem", "multi_year")
    return union_imposed([table(spark, sf_dir, "lineitem")], schema.names, schema)


@query("select o_orderkey, o_custkey + 100000000000000 as person_id from orders")
def offset_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.select("o_orderkey", key_with_offset(F.col("o_custkey")).alias("person_id"))


@query("""
    select l_orderkey, l_linenumber,
           (l_extendedprice::decimal(18, 4) * (1 - l_discount::decimal(18, 4)))::decimal(18, 2) as net
    from lineitem
""")
def round_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    price, discount = F.col("l_extendedprice").cast("decimal(18,4)"), F.col("l_discount").cast("decimal(18,4)")
    net = money(price * (1 - discount), MONEY).alias("net")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", net)


@query("select l_orderkey, l_linenumber, l_shipdate::date::timestamp as ship_day from lineitem")
def date_to_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("date").alias("ship_day")
    )
    return union_imposed([shipped], shipped.columns, shipped.schema)


@query("select o_orderkey, coalesce(nullif(o_orderstatus, 'P'), '9') as code from orders")
def null_to_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    return table(spark, sf_dir, "orders").select("o_orderkey", code_for_null(status, "9").alias("code"))


@query(f"select * from (select o_orderkey, {KEY_SQL} as cust_key from orders) where coalesce(cust_key, '') <> ''")
def drop_blank_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = table(spark, sf_dir, "orders").select("o_orderkey", built_key().alias("cust_key"))
    return keyed.where(not_blank(F.col("cust_key"), T.StringType()))


@query("select l_orderkey, l_linenumber, true as shifted from lineitem")
def surrogate_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids differ from run to run, so only their range is shown; tests check that they are unique."""
    ids = with_surrogate_id(table(spark, sf_dir, "lineitem"), "seqnum", offset=10**12)
    return ids.select("l_orderkey", "l_linenumber", (F.col("seqnum") >= 10**12).alias("shifted"))


@query("select l_orderkey, l_linenumber, 1::bigint as holders, true as again from lineitem")
def reproducible_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every id is held by one row, and a second run over other columns and filters gives each row the same."""
    lineitem = table(spark, sf_dir, "lineitem")
    ids = with_reproducible_id(lineitem).select("seqnum", "l_orderkey", "l_linenumber", F.xxhash64(*lineitem.columns).alias("row"))
    holders = ids.groupBy("seqnum").agg(F.count("*").alias("holders"))
    halves = [with_reproducible_id(lineitem.where(kept)) for kept in ("l_linenumber % 2 = 0", "l_linenumber % 2 <> 0")]
    second = halves[0].unionByName(halves[1]).select("seqnum", F.xxhash64(*lineitem.columns).alias("row_again"))
    return ids.join(holders, "seqnum").join(second, "seqnum").select(
        "l_orderkey", "l_linenumber", "holders", (F.col("row") == F.col("row_again")).alias("again"))


@query("""
    select coalesce(nullif(l_returnflag, 'R'), '9') as value, count(*) as n from lineitem group by 1
""")
def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.nullif(F.col("l_returnflag"), F.lit("R")).alias("flag")
    return frequencies(table(spark, sf_dir, "lineitem").select(flag), "flag", "9")


@query("select count(*) as n from lineitem")
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_rows(table(spark, sf_dir, "lineitem"))


@query("select *, row_number() over (order by o_orderdate, o_orderkey) as row_id from orders")
def dense_row_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return number_rows(table(spark, sf_dir, "orders"), ["o_orderdate", "o_orderkey"])
