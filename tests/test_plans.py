"""What the plans must not contain, and what they must."""

import pytest

import __spark_entry__ as entry
from checks.inputs import frame
from ferrytally.operators import compare

QUERIES = entry.queries()
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", [
    "compare_tables", "compare_tables_duplicate_keys", "compare_tables_hot_key", "compare_join", "rows_left_only",
    "column_stats", "sample_sync_random", "key_tuple_filter", "schema_summary", "fuzzy_schema_join", "auto_types",
    "status_update_join", "select_ids", "explode_outputs", "producers_of", "consumers_of", "flow_scores", "stage_models",
    "row_count_diff", "executive_summary", "batch_summary", "apply_schema",
])
def test_no_cross_join_and_no_python(spark, sf, key):
    text = plan(QUERIES[key](spark, sf))
    assert not [f for f in FORBIDDEN if f in text]


def test_unique_keys_join_directly(spark, sf):
    text = plan(compare.compare_join(frame(spark, sf, "orders"), frame(spark, sf, "right_orders"), ["o_orderkey"]))
    assert "FullOuter" in text and "Window" not in text and text.count("Exchange") == 2


def test_repeated_keys_are_paired_after_one_exchange(spark, sf):
    left, right = frame(spark, sf, "lineitem"), frame(spark, sf, "right_lineitem")
    text = plan(compare.compare_join(left, right, ["l_orderkey", "l_linenumber"]))
    assert text.count("Exchange") == 1 and "Union" in text and "Join" not in text


def test_only_compared_columns_are_read(spark, sf):
    left = frame(spark, sf, "orders")
    right = left.select("o_orderkey", "o_totalprice")
    text = plan(compare.column_stats(left, right, ["o_orderkey"]))
    assert "o_orderpriority" not in text and "o_orderdate" not in text


def test_left_only_shuffles_counts_of_the_right_side(spark, sf):
    left, right = frame(spark, sf, "orders"), frame(spark, sf, "right_orders")
    text = plan(compare.left_only(left, right, ["o_orderkey"]))
    assert "partial_count" in text
