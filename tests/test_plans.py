"""Physical plans: what must reach the scan, what must not be in a plan."""

import contextlib
import io
import re

import pytest

from purseflow import plans  # noqa: F401
from purseflow.plans.registry import REPORTS


def explain(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name, filters, columns", [
    ("q6_failed_high_value", ["EqualTo(o_orderstatus,P)", "GreaterThan(o_totalprice,400000.0)"], 5),
    ("fraud_rules", ["EqualTo(o_orderstatus,P)", "GreaterThan(o_totalprice,400000.0)"], 3),
    ("dash_alert_count", ["Not(EqualTo(o_orderstatus,F))", "GreaterThan(o_totalprice,450000.0)"], 2),
    ("month_category_range", ["EqualTo(o_orderstatus,F)", "GreaterThanOrEqual(o_orderdate,1996-01-01"], 4),
    ("point_lookup", ["EqualTo(o_orderkey,42)"], 6),
    ("gst_inclusive_total", [], 1),
    ("category_counts", [], 1),
])
def test_filters_and_columns_reach_the_scan(spark, folder, name, filters, columns):
    plan = explain(REPORTS[name](spark, folder))
    pushed = re.search(r"PushedFilters: (.*)", plan)
    for text in filters:
        assert text in pushed.group(1)
    schema = re.search(r"ReadSchema: struct<(.*)>", plan).group(1)
    assert len(schema.split(",")) == columns


# streams and snapshots return a read of what they have written
PLANNED = sorted(n for n in REPORTS if not n.startswith(("stream_", "snapshot_", "run_summary")))


@pytest.mark.parametrize("name", PLANNED)
def test_no_product_joins(spark, folder, name):
    plan = explain(REPORTS[name](spark, folder))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["w_rank_category_top", "head_per_month"])
def test_top_rows_are_limited_before_the_shuffle(spark, folder, name):
    plan = explain(REPORTS[name](spark, folder))
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")
    assert plan.count("WindowGroupLimit") >= 2


@pytest.mark.parametrize("name", ["q1_high_value", "q4_top_merchants", "top4_categories", "hash_sample"])
def test_top_k_needs_no_total_sort(spark, folder, name):
    plan = explain(REPORTS[name](spark, folder))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_no_python_in_any_plan(spark, folder):
    for name in ["clean_rows", "clean_string", "dq_score", "silver_txns", "synth_txns", "replicate_11x"]:
        plan = explain(REPORTS[name](spark, folder))
        assert "Python" not in plan and "Pandas" not in plan


def test_ranks_need_one_range_exchange_and_no_second_shuffle_of_rows(spark, folder):
    plan = explain(REPORTS["w_rank_category"](spark, folder))
    # the ranges are stored; what is left is one row per range, broadcast
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") >= 1


def test_distinct_counts_do_not_multiply_rows(spark, folder):
    assert "Expand" not in explain(REPORTS["dq_completeness"](spark, folder))


def test_a_filter_on_the_calendar_prunes_the_lake_at_run_time(spark, folder):
    plan = explain(REPORTS["lake_first_quarter"](spark, folder))
    assert re.search(r"PartitionFilters: .*dynamicpruning", plan)
