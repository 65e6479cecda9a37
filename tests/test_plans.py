"""Plan-shape regression tests: the physical plans the scale design relies on.

Plans are taken as they start on large tables: no broadcast joins and AQE
off (AQE only improves on them at run time).
"""

from __future__ import annotations

import os
import re

import pytest

from quarry.plans.catalog import QUERIES
from tests.conftest import conf

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def plan(spark, name: str) -> str:
    with conf(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__enabled="false",
    ):
        df = QUERIES[name](spark, SF)
        return df._jdf.queryExecution().executedPlan().toString()


def exchanges(p: str) -> list[str]:
    return re.findall(r"Exchange (hashpartitioning\([^)]*\)|SinglePartition|RoundRobinPartitioning\(\d+\))", p)


def test_log_parse_runs_the_regex_once_per_line(spark):
    p = plan(spark, "parse_access_log")
    assert "Generate explode" in p
    # tested and taken apart in one pass, and not again by a pushed-down filter;
    # only lines that hold a newline take the per-group path
    assert p.count("regexp_replace(") == 1


def test_spend_pre_aggregates_orders_and_reuses_its_partitioning(spark):
    p = plan(spark, "spend_by_group")
    ex = exchanges(p)
    # orders by customer (pre-aggregation), customers by key, final by segment:
    # the join adds no exchange of its own
    assert len(ex) == 3, ex
    assert "partial_sum(cast(o_totalprice" in p


def test_distinct_locations_shuffles_line_items_once(spark):
    p = plan(spark, "product_distinct_locations")
    ex = exchanges(p)
    assert sum("l_orderkey" in e for e in ex) == 1
    # lineitem, orders, customer, orders⟕customer by order key, and two for
    # distinct-then-count, which shuffle distinct pairs only
    assert len(ex) == 6, ex
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in p


def test_range_filter_is_pushed_into_the_scan(spark):
    p = plan(spark, "range_filter")
    assert "GreaterThanOrEqual(p_size,22)" in p and "LessThanOrEqual(p_size,25)" in p
    assert "ReadSchema: struct<p_name:string,p_size:int>" in p


def test_top_k_is_bounded(spark):
    for name in ("top_endpoints", "sql_top_endpoints", "top_location"):
        assert "TakeOrderedAndProject" in plan(spark, name), name


def test_counts_combine_map_side(spark):
    for name in ("word_count", "heavy_hitters", "response_code_counts", "endpoint_counts"):
        p = plan(spark, name)
        assert "partial_count" in p, name


def test_no_python_in_any_plan(spark):
    for name in QUERIES:
        if name.startswith("stream_"):
            continue
        p = plan(spark, name)
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_generators_stay_in_whole_stage_codegen(spark):
    # the final (post-AQE) plan: parse/tokenise run fused with the partial
    # aggregate in one generated-code stage
    for name in ("log_stats", "word_count"):
        df = QUERIES[name](spark, SF)
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert re.search(r"\*\(\d+\) Generate explode", final), name
        assert re.search(r"\*\(\d+\) HashAggregate\(keys=\[[^\]]*\], functions=\[partial_", final), name
