"""Queries for previews, names, profiles, overlays, generated data and SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from querybook.book import query, table
from tableprep.functions.fixed import CLASS_LABELS, NON_RESERVED_KEYWORDS, RESERVED_KEYWORDS, TOO_HIGH, bucket_label
from tableprep.operators import masking, overlay, profile
from tableprep.operators.colnames import reserved_word_names
from tableprep.operators.colnames import strip_common_prefix as strip_prefix
from tableprep.operators.generate import pi_of_points, random_block
from tableprep.operators.views import preview as preview_of
from tableprep.operators.views import schema_report as report_schema
from tableprep.operators.views import view_from_parquet as view_of
from tableprep.plans.projection import union_all
from tableprep.plans.sqljobs import sql_file_job as run_sql_file
from tableprep.plans.sqljobs import sql_query as run_sql
from tableprep.sinks.writers import write_text_blob
from tableprep.storage import scratch_dir


@query("""
    select l_returnflag, count(*) as n, sum(l_quantity) as quantity from lineitem group by l_returnflag
""")
def view_from_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    view_of(spark, f"{sf_dir}/lineitem.parquet", "lineitem_view")
    return spark.sql(
        "select l_returnflag, count(*) as n, sum(l_quantity) as quantity from lineitem_view group by l_returnflag"
    )


@query("""
    select doc_id::varchar as doc_id,
           case when length(text) > 20 then substr(text, 1, 17) || '...' else coalesce(text, 'null') end as text,
           lang, source, n_chars::varchar as n_chars
    from documents order by documents.doc_id limit 20
""")
def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview_of(table(spark, sf_dir, "documents"), rows=20, width=20, order_by=["doc_id"])


LINEITEM_TYPES = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int", "l_quantity": "double",
    "l_extendedprice": "double", "l_discount": "double", "l_tax": "double", "l_returnflag": "string",
    "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
}


@query(
    " union all ".join(
        f"select {i} as ordinal, '{c}' as col, '{t}' as type, {str(t != 'timestamp_ntz').lower()} as supported, "
        f"count(*) as n_rows, count({c}) as n_filled from lineitem"
        for i, (c, t) in enumerate(LINEITEM_TYPES.items())
    )
)
def schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report_schema(table(spark, sf_dir, "lineitem"), filled_counts=True).withColumnRenamed("column", "col")


@query("select * from orders")
def strip_common_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return strip_prefix(orders.toDF(*[f"t.{c}" for c in orders.columns]))


def words_sql(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


@query(f"""
    select name, count(*) as n, upper(name) in ({words_sql(RESERVED_KEYWORDS)}) as is_reserved,
           upper(name) in ({words_sql(NON_RESERVED_KEYWORDS)}) or upper(name) in ({words_sql(RESERVED_KEYWORDS)})
           as is_forbidden
    from (select role as name from conversations union all select event_type from events
          union all select lang from documents union all select c_mktsegment from customer
          union all select unnest(string_split(p_name, ' ')) from part)
    group by name
""")
def reserved_word_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that would turn into column names in a pivot, checked against the keywords."""
    names = [
        table(spark, sf_dir, "conversations").select(F.col("role").alias("name")),
        table(spark, sf_dir, "events").select("event_type"),
        table(spark, sf_dir, "documents").select("lang"),
        table(spark, sf_dir, "customer").select("c_mktsegment"),
        table(spark, sf_dir, "part").select(F.explode(F.split("p_name", " "))),
    ]
    return reserved_word_names(union_all(names).groupBy("name").agg(F.count("*").alias("n")), "name")


LABELS_SQL = ", ".join(
    "({}, {})".format(i, f"chr({i})" if i == 39 else "'" + bucket_label(i).replace("'", "''") + "'")
    for i in range(TOO_HIGH + len(CLASS_LABELS)) if i != 39
) + ", (39, '  ''')"


@query(f"""
    select lang, bucket, n, label
    from (select lang, least(unicode(ch), 256) as bucket, count(*) as n
          from (select lang, unnest(string_split(text, '')) as ch from documents) where ch <> '' group by 1, 2) counts
    join (values {LABELS_SQL}) labels(b, label) on bucket = b
""")
def char_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.char_histogram(table(spark, sf_dir, "documents"), "text", ["lang"])


def removed_sql(pattern: str) -> str:
    return f"sum(length(text) - length(regexp_replace(text, '{pattern}', '', 'g')))::bigint"


LEADING_SQL = "sum(case when starts_with(text, '-') then 1 else 0 end)::bigint"


@query(f"""
    select lang, sum(length(text))::bigint - {removed_sql('[0-9]')} as non_digit,
           {removed_sql(chr(92) + 'p{L}')} as letter, {removed_sql('[0-9]')} as digit,
           {removed_sql('[ -/:-@' + chr(92) + '[-`{-~]')} as typeable_other,
           sum(length(regexp_replace(text, '[{chr(92)}p{{L}}0-9 -~]', '', 'g')))::bigint as non_typeable,
           {removed_sql('[ --/:-~]')} - {LEADING_SQL} as not_number,
           {removed_sql('[!-,;-SU-Y' + chr(92) + '[-~]')} + {LEADING_SQL} as not_date,
           {LEADING_SQL} as leading, {removed_sql('-')} - {LEADING_SQL} as non_leading
    from documents group by lang
""")
def char_class_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.char_class_totals(table(spark, sf_dir, "documents"), "text", ["lang"])


@query("""
    select doc_id, case when starts_with(text, '-') then 1 else 0 end::bigint as leading,
           (length(text) - length(replace(text, '-', '')) - case when starts_with(text, '-') then 1 else 0 end)::bigint
           as non_leading
    from documents
""")
def hyphen_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.hyphen_position(table(spark, sf_dir, "documents"), "text").select(
        "doc_id", "leading", "non_leading"
    )


SETTING_KEY_SQL = """case event_id % 4 when 0 then 'db_password' when 1 then 'AWS_Access_Key_Id'
    when 2 then 'userPasswordFid' else 'user_' || user_id end"""


@query(f"""
    select event_id, setting, case when event_id % 4 in (0, 1) then 'XXXXXXXX' else props end as value
    from (select event_id, props, {SETTING_KEY_SQL} as setting from events)
""")
def mask_sensitive(spark: SparkSession, sf_dir: str) -> DataFrame:
    case = F.col("event_id") % 4
    key = (
        F.when(case == 0, "db_password").when(case == 1, "AWS_Access_Key_Id").when(case == 2, "userPasswordFid")
        .otherwise(F.concat(F.lit("user_"), F.col("user_id").cast("string")))
    )
    settings = table(spark, sf_dir, "events").select("event_id", key.alias("setting"), F.col("props").alias("value"))
    return masking.mask_sensitive(settings, "setting", "value")


@query("""
    select o_orderkey, o_custkey, 'XXXXXXXX' as db_password, o_totalprice, o_orderdate,
           o_orderpriority as "userPasswordFid"
    from orders
""")
def mask_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return masking.mask_columns(
        orders.withColumnsRenamed({"o_orderstatus": "db_password", "o_orderpriority": "userPasswordFid"})
    )


@query("""
    select user_id, setting from (
        select user_id, setting,
               row_number() over (partition by user_id order by setting is null, event_type desc, event_id desc) as rn
        from (select *, case when event_type = 'view' then null else props end as setting from events))
    where rn = 1
""")
def layered_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event types as layers, later events over earlier ones, nulls falling through."""
    value = F.when(~F.col("event_type").eqNullSafe("view"), F.col("props")).alias("setting")
    settings = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", value)
    return overlay.layered_overlay(settings, "user_id", "setting", ["event_type", "event_id"])


@query("""
    select coalesce(t.doc_id, b.doc_id) as doc_id, coalesce(t.quality, b.quality) as quality, t.toxic, b.source
    from (select doc_id, case when toxic = 0 then quality end as quality, toxic from labels) t
    full join (select doc_id, (n_chars % 2)::int as quality, source from documents) b on t.doc_id = b.doc_id
""")
def overlay_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels laid over a guess made from the documents; toxic labels fall through."""
    quality = F.when(F.col("toxic") == 0, F.col("quality")).alias("quality")
    top = table(spark, sf_dir, "labels").select("doc_id", quality, "toxic")
    base = table(spark, sf_dir, "documents").select(
        "doc_id", (F.col("n_chars") % 2).cast("int").alias("quality"), "source"
    )
    return overlay.overlay_tables([top, base], ["doc_id"])


LATTICE = 10007


@query(f"""
    select samples, inside, 4.0::double * inside / samples as pi
    from (select count(*) as samples, count(*) filter (where x * x + y * y < {LATTICE * LATTICE}) as inside
          from (select (7919 * l_orderkey + 31 * l_linenumber) % {LATTICE} as x,
                       (104729 * l_partkey + 17 * l_suppkey) % {LATTICE} as y
                from lineitem))
""")
def estimate_pi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One point per line item, scattered by remainders in place of random draws."""
    points = table(spark, sf_dir, "lineitem").select(
        ((7919 * F.col("l_orderkey") + 31 * F.col("l_linenumber")) % LATTICE).alias("x"),
        ((104729 * F.col("l_partkey") + 17 * F.col("l_suppkey")) % LATTICE).alias("y"),
    )
    return pi_of_points(points, F.col("x"), F.col("y"), F.lit(LATTICE).cast("bigint"))


@query("select o_orderkey, 1024 as n_bytes from orders")
def generate_bulk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A random block for every order; only the sizes can be compared."""
    blocks = table(spark, sf_dir, "orders").select("o_orderkey", random_block(7).alias("block"))
    return blocks.select("o_orderkey", F.octet_length("block").alias("n_bytes"))


SQL_TEXTS = {
    "sql_query": """
        select l_returnflag, l_linestatus, count(*) as n, sum(l_quantity) as quantity, max(l_shipdate) as last_shipped
        from lineitem group by l_returnflag, l_linestatus""",
    "sql_join_inner": """
        select n_name, count(*) as n_orders from customer join nation on c_nationkey = n_nationkey
        join orders on o_custkey = c_custkey group by n_name""",
    "sql_semi_anti": """
        select c_custkey, 'has' as k from customer where exists (select 1 from orders where o_custkey = c_custkey)
        union all
        select c_custkey, 'none' as k from customer
        where not exists (select 1 from orders where o_custkey = c_custkey)""",
    "sql_rollup": """
        select o_orderstatus, o_orderpriority, count(*) as n from orders
        group by rollup(o_orderstatus, o_orderpriority)""",
    "sql_window_rank": """
        select user_id, event_id, cast(rn as bigint) as rn
        from (select user_id, event_id, row_number() over (partition by user_id order by ts, event_id) as rn
              from events) q where rn <= 3""",
    "sql_topk": "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 25",
    "sql_intersect_except": """
        (select c_nationkey as k from customer intersect select s_nationkey as k from supplier)
        union all
        (select n_nationkey as k from nation except select s_nationkey as k from supplier)""",
    "sql_scalars": """
        select c_custkey, upper(c_mktsegment) as seg, case when c_acctbal < 0 then 'neg' else 'pos' end as sgn,
               coalesce(nullif(c_mktsegment, 'BUILDING'), 'other') as alt, substr(c_name, 10) as num
        from customer""",
}
SQL_TABLES = ("customer", "nation", "supplier", "orders", "lineitem", "events")


def register_sql(name: str, text: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        used = {t: table(spark, sf_dir, t) for t in SQL_TABLES if t in text}
        return run_sql(spark, text, used)

    run.__name__ = name
    query(text)(run)


for _name, _text in SQL_TEXTS.items():
    register_sql(_name, _text)

FILE_SQL = """
    select o_orderpriority, count(*) as n, min(o_orderdate) as first_day
    from orders group by o_orderpriority"""


@query(FILE_SQL)
def sql_file_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    location = scratch_dir(spark, "sqlfile") + "/orders_by_priority.sql"
    write_text_blob(spark, FILE_SQL, location)
    return run_sql_file(spark, location, {"orders": table(spark, sf_dir, "orders")})
