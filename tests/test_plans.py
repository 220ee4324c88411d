"""Plan-shape guards for every registered query: no cross products,
nested-loop joins or Python evaluation; paging is a bounded top-k; filters
reach the scans."""

import pytest
from conftest import SF_SMALL
from martlens.plans import QUERIES

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "localCheckpoint")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_products_or_python_in_plan(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert not [f for f in FORBIDDEN if f in plan]


def test_paging_is_a_bounded_top_k(spark):
    plan = _plan(QUERIES["sale_search_page"](spark, SF_SMALL))
    assert "TakeOrderedAndProject(limit=40, offset=20" in plan


def test_keyword_filter_reaches_the_part_scan(spark):
    plan = _plan(QUERIES["sale_search_hits"](spark, SF_SMALL))
    part_scan = [line for line in plan.splitlines() if "FileScan parquet" in line and "part.parquet" in line]
    assert part_scan and "regexp_extract_all" in part_scan[0]
