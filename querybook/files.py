"""Queries for sources and sinks. What a sink wrote is read back and compared with what it was given."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from querybook.book import TABLES, query, table
from tableprep.operators.sizing import compact as compact_table
from tableprep.operators.sizing import compaction_plan as plan_compaction
from tableprep.operators.sizing import recommend_partitions as recommend
from tableprep.sinks import writers
from tableprep.sinks.range_named import write_range_named as write_named
from tableprep.sources import listing, readers
from tableprep.storage import scratch_dir
from tableprep.streaming import incremental

FILE_NAME = "_metadata.file_name"


@query("select l_orderkey, l_linenumber, l_shipdate from lineitem")
def read_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_parquet(spark, f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_shipdate")


def orders_through(spark: SparkSession, sf_dir: str, fmt: str) -> DataFrame:
    """Orders written in a format and read back under their schema."""
    orders = table(spark, sf_dir, "orders")
    location = scratch_dir(spark, fmt) + "/orders"
    getattr(writers, f"write_{fmt}")(orders, location)
    return getattr(readers, f"read_{fmt}")(spark, location, schema=orders.schema)


@query("select * from orders")
def write_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_through(spark, sf_dir, "parquet")


@query("select * from orders")
def write_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_through(spark, sf_dir, "orc")


@query("select o_orderstatus, count(*) as n, min(o_orderdate) as first_day from orders group by 1")
def read_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = orders_through(spark, sf_dir, "orc")
    return orders.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.min("o_orderdate").alias("first_day"))


@query("select * from orders")
def write_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_through(spark, sf_dir, "csv")


@query("select o_orderkey::varchar as _c0, o_custkey::varchar as _c1, o_orderstatus as _c2 from orders")
def read_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No header row and no schema: text columns with generated names."""
    location = scratch_dir(spark, "csv") + "/orders"
    writers.write_csv(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), location)
    return readers.read_csv(spark, location)


@query("select p_name || ' #' || p_partkey as value from part")
def write_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    location = scratch_dir(spark, "text") + "/part"
    line = F.concat("p_name", F.lit(" #"), F.col("p_partkey").cast("string")).alias("value")
    writers.write_text(table(spark, sf_dir, "part").select(line), location)
    return readers.read_text(spark, location)


@query("select length(value) as n_chars, count(*) as n from (select c_name as value from customer) group by 1")
def read_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    location = scratch_dir(spark, "text") + "/customer"
    writers.write_text(table(spark, sf_dir, "customer").select("c_name"), location)
    lines = readers.read_text(spark, location)
    return lines.groupBy(F.length("value").cast("bigint").alias("n_chars")).agg(F.count("*").alias("n"))


@query("select conv_id::varchar as conv_id, turn::varchar as turn, role, text from conversations")
def read_header_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text with line breaks and quotes inside quoted fields."""
    location = scratch_dir(spark, "headercsv") + "/conversations"
    turns = table(spark, sf_dir, "conversations")
    writers.write_csv(turns, location, header=True, quote='"', escape='"', quoteAll=True)
    return readers.read_header_csv(spark, location)


@query("select o_orderkey || '|' || o_orderpriority as value from orders")
def read_lines_nonempty(spark: SparkSession, sf_dir: str) -> DataFrame:
    location = scratch_dir(spark, "lines") + "/orders"
    line = F.concat_ws("|", "o_orderkey", "o_orderpriority").alias("value")
    writers.write_text(table(spark, sf_dir, "orders").select(line), location)
    return readers.read_lines(spark, location)


@query("""
    select o_orderstatus as status, row_number() over (partition by o_orderstatus order by o_orderkey) as line_no,
           o_orderkey || '|' || o_orderpriority as value
    from orders
""")
def read_lines_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as one text file for each status, in order of their keys, numbered file by file."""
    location = scratch_dir(spark, "numbered") + "/orders"
    line = F.concat_ws("|", "o_orderkey", "o_orderpriority").alias("value")
    orders = table(spark, sf_dir, "orders").repartition("o_orderstatus").sortWithinPartitions("o_orderstatus", "o_orderkey")
    orders.select(line, F.col("o_orderstatus").alias("status")).write.partitionBy("status").text(location)
    lines = readers.read_lines(spark, location, numbered=True)
    return lines.select(F.regexp_extract("file", "/status=([^/]*)/", 1).alias("status"), "line_no", "value")


COUNTS_SQL = " union all ".join(f"select '{t}.parquet' as name, count(*) as n_rows from {t}" for t in TABLES)


@query(f"select name, n_rows, true as has_bytes from ({COUNTS_SQL})")
def file_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every table file with its size and the rows its footer counts."""
    files = listing.file_catalog(spark, sf_dir, "*.parquet")
    name = F.regexp_extract("path", r"([^/]+)$", 1).alias("name")
    rows = readers.read_parquet(spark, sf_dir, schema="unread int").groupBy(F.col(FILE_NAME).alias("name"))
    counted = rows.agg(F.count("*").alias("n_rows"))
    return files.select(name, (F.col("length") > 0).alias("has_bytes")).join(counted, "name")


@query("select 'status=' || o_orderstatus as directory, count(*) as n_rows, true as has_files from orders group by 1")
def file_catalog_recursive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written into nested directories, listed at depth and compared with the rows of each directory."""
    location = scratch_dir(spark, "catalog") + "/orders"
    orders = table(spark, sf_dir, "orders").withColumn("status", F.col("o_orderstatus"))
    writers.partitioned_sink(orders, location, ["status"])
    directory = r"/([^/]+)/[^/]+$"
    files = listing.file_catalog_recursive(spark, location, "*.parquet")
    sizes = files.groupBy(F.regexp_extract("path", directory, 1).alias("directory")).agg(F.count("*").alias("files"))
    rows = readers.read_parquet(spark, location, schema="unread int", recursiveFileLookup=True)
    counted = rows.groupBy(F.regexp_extract("_metadata.file_path", directory, 1).alias("directory"))
    return sizes.join(counted.agg(F.count("*").alias("n_rows")), "directory").select(
        "directory", "n_rows", (F.col("files") > 0).alias("has_files")
    )


@query("select *, true as is_gzip from customer")
def write_gzip_intermediate(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = scratch_dir(spark, "gzip") + "/raw/customer"
    path = writers.write_gzip_intermediate(table(spark, sf_dir, "customer"), raw)
    return readers.read_parquet(spark, path).select("*", F.col(FILE_NAME).endswith(".gz.parquet").alias("is_gzip"))


@query("""
    select n_name || ': ' || count(*) as value from nation join customer on n_nationkey = c_nationkey group by n_name
""")
def write_text_blob(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report of one line per nation, made in Spark and written as one text."""
    nation, customer = table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer")
    counts = customer.groupBy("c_nationkey").agg(F.count("*").alias("n"))
    lines = counts.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.concat("n_name", F.lit(": "), F.col("n").cast("string")).alias("line")
    )
    body = lines.agg(F.array_join(F.array_sort(F.collect_list("line")), "\n").alias("value"))
    location = scratch_dir(spark, "blob") + "/report"
    writers.write_text_blob(spark, body, location)
    return readers.read_text(spark, location)


@query("select l_orderkey, l_linenumber, true as named from lineitem")
def write_range_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    location = scratch_dir(spark, "named") + "/LineItem"
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    write_named(rows, location)
    named = F.col(FILE_NAME).rlike(r"^lineitem-(\d+in0+to\d+|single)\.snappy\.parquet$").alias("named")
    return readers.read_parquet(spark, location).select("*", named)


@query("select * from customer")
def save_prefixed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    location = scratch_dir(spark, "table") + "/customer"
    name = writers.save_prefixed_table(table(spark, sf_dir, "customer"), "customer", "stg", "overwrite", location)
    return spark.table(name)


@query("select * from orders")
def partitioned_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    location = scratch_dir(spark, "partitioned") + "/orders"
    writers.partitioned_sink(orders, location, ["o_orderpriority"], fmt="orc")
    return readers.read_orc(spark, location, schema=orders.schema)


@query("select count(*) as n_rows, true as few_sampled, true as in_proportion, true as follows from lineitem")
def recommend_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compressed sizes cannot be told in SQL; that all rows were counted, that few were written, that the estimate is of
    the order of the source's own size and that the number of files follows from it can."""
    lineitem = table(spark, sf_dir, "lineitem")
    files = lineitem.groupBy("_metadata.file_path").agg(F.max("_metadata.file_size").alias("size"))
    source = files.agg(F.sum("size")).first()[0]
    found = recommend(lineitem, target_bytes=100_000)
    follows = F.greatest(F.lit(1), F.floor(F.lit(0.5) + F.col("estimated_bytes") / 100_000))
    return found.select(
        "n_rows", F.col("sampled_rows").between(1, F.least(F.col("n_rows"), F.lit(4 << 14))).alias("few_sampled"),
        F.col("estimated_bytes").between(source * 0.4, source * 1.6).alias("in_proportion"),
        (F.col("recommended") == follows).alias("follows"))


@query("select l_orderkey, l_linenumber, true as as_planned from lineitem")
def compaction_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of many files, planned and rewritten; every row must survive in the planned number of files."""
    location = scratch_dir(spark, "compaction")
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    writers.write_parquet(rows, f"{location}/small")
    planned = plan_compaction(spark, f"{location}/small").select("recommended")
    compact_table(spark, f"{location}/small", f"{location}/sized")
    files = plan_compaction(spark, f"{location}/sized").select("files")
    as_planned = planned.first()[0] == files.first()[0]
    return readers.read_parquet(spark, f"{location}/sized").withColumn("as_planned", F.lit(as_planned))


@query("""
    select *, case when o_orderkey * 5 <= (select max(o_orderkey) from orders) * 4 then 'loaded' else 'new' end as batch
    from orders
""")
def incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four fifths of the key range are in the target already; the rest is found by the high-water mark."""
    orders = table(spark, sf_dir, "orders")
    highest = incremental.high_water_mark(orders, "o_orderkey")
    target = orders.where(F.col("o_orderkey") * 5 <= F.lit(highest * 4))
    new = incremental.incremental_load(orders, target, "o_orderkey")
    return target.withColumn("batch", F.lit("loaded")).union(new.withColumn("batch", F.lit("new")))


@query("select *, case when o_orderkey % 5 = 0 then 'late' else 'loaded' end as batch from orders")
def incremental_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fifth of the orders was missing at the first load and lies at or before its last day, which many orders share."""
    orders, last = table(spark, sf_dir, "orders"), F.lit(datetime.date(2030, 1, 1))
    is_late = F.col("o_orderkey") % 5 == 0
    before = F.date_sub(last, (F.col("o_orderkey") % 7).cast("int"))
    first = orders.where(~is_late).withColumn("day", last)
    source = orders.withColumn("day", F.when(is_late, before).otherwise(last))
    late = incremental.incremental_load(source, first, "day", ["o_orderkey"], datetime.timedelta(days=6))
    return first.withColumn("batch", F.lit("loaded")).union(late.withColumn("batch", F.lit("late"))).drop("day")


@query("select * from events")
def incremental_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    location = scratch_dir(spark, "stream")
    for _ in range(2):
        incremental.incremental_stream(
            spark, f"{sf_dir}/events.parquet", events.schema, f"{location}/events", f"{location}/progress"
        )
    return readers.read_parquet(spark, f"{location}/events", schema=events.schema)
