"""Plans are the ones we want: filters and columns reach the scan, no Python, no nested loops, no global windows."""

import re

import pytest

from tidewell.plans import registry



def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pushdown(spark, sf):
    text = plan(registry.QUERIES["registry_left_join"](spark, sf))
    assert "PushedFilters: [IsNotNull(l_linenumber), EqualTo(l_linenumber,1)" in text
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert any("l_partkey" in s and "l_comment" not in s and "l_extendedprice" not in s for s in schemas)


@pytest.mark.parametrize("name", ["dup_suggestions", "rule_cascade", "size_candidate_pairs", "longest_prefix", "protected_reasons", "series_complete", "nearest_neighbour", "unit_rollup", "store_currency", "alias_pairs", "sibling_labels"])
def test_no_python_and_no_nested_loops(spark, sf, name):
    text = plan(registry.QUERIES[name](spark, sf))
    assert not re.search(r"ArrowEvalPython|BatchEvalPython|MapInPandas|MapInArrow|FlatMapGroups", text)
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", text)


@pytest.mark.parametrize("name", ["dup_suggestions", "ticket_outcomes", "mode_shape", "brightest", "final_tree"])
def test_extremes_are_aggregations(spark, sf, name):
    assert "Window" not in plan(registry.QUERIES[name](spark, sf))
