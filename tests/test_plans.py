"""Plans of all registered queries: what must never appear at scale, and what must."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as book
from querybook.book import QUERIES
from tests.test_reconcile import explained

SF_DIR = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "FlatMapGroupsInPandas", "GlobalLimit")
# one row per task, or the top rows only, come together here
GLOBAL_AGGREGATES = {"drift_report", "resolve_types", "schema_report", "row_count", "estimate_pi"}


@pytest.fixture(scope="module")
def plans(spark):
    return {name: explained(run(spark, SF_DIR)) for name, run in QUERIES.items()}


def tree(plan):
    return plan.split("\n\n\n")[0]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_nothing_quadratic_and_nothing_per_row_in_python(plans, name):
    assert not [word for word in FORBIDDEN if word in tree(plans[name])]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_single_partitions_hold_partial_aggregates_only(plans, name):
    if name not in GLOBAL_AGGREGATES:
        assert "SinglePartition" not in plans[name]


@pytest.mark.parametrize(
    "name",
    ["resolved_union", "discover_tables", "source_tag", "read_parquet_instances", "imposed_union", "select_columns_ci",
     "lookup_schema", "round_money", "surrogate_id", "mask_sensitive", "mask_columns", "hyphen_position"],
)
def test_narrow_operators_do_not_shuffle(plans, name):
    assert "Exchange" not in tree(plans[name])


@pytest.mark.parametrize("name", ["value_counts", "layered_overlay", "overlay_tables", "reserved_word_columns",
                                  "char_histogram", "char_class_totals"])
def test_aggregates_combine_before_their_only_shuffle(plans, name):
    assert tree(plans[name]).count("Exchange") == 1
    assert "partial_" in plans[name]


def test_columns_are_pruned(spark, plans):
    schemas = re.findall(r"ReadSchema: struct<(.*)>", plans["value_counts"])
    assert schemas == ["l_returnflag:string"]
    keys = QUERIES["resolved_union"](spark, SF_DIR).where(F.col("o_orderkey") > 5).select("o_orderkey")
    details = explained(keys)
    assert details.count("GreaterThan(o_orderkey,5)") == 3
    assert all("o_totalprice" not in s for s in re.findall(r"ReadSchema: (.*)", details))


def test_row_counts_need_no_column(plans):
    assert re.findall(r"ReadSchema: struct<(.*)>", plans["row_count"]) == [""]
