"""Physical plans: what must, and what must not, be in them."""

import pytest

from meterline.operators.filters import derive_and_guard
from meterline.operators.splits import carve_holdout
from meterline.plans import fixtures as X
from meterline.registry import QUERIES
from meterline.session import pin


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "c10_monthly_zone_revenue", "c04_dedup_keep_first", "f06_zones_known_flag", "f07_attach_route", "g05_exact_caps", "g11_key_audit",
    "g17_histogram", "h01_sequence_trips", "j08_carve_holdout", "l05_heatmap", "l17_flow_edges", "m01_oof_target_encode",
])
def test_no_cross_products_and_no_python_in_plans(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups"):
        assert operator not in text


def test_flagship_reads_few_columns_and_shuffles_once_after_the_joins(spark, sf):
    text = plan(QUERIES["c10_monthly_zone_revenue"](spark, sf))
    assert "l_returnflag" not in text and "l_shipdate" not in text and "o_orderstatus" not in text
    assert text.count("HashAggregate") == 2 and "SortMergeJoin" not in text


def test_holdout_compares_rows_without_moving_them(spark, sf):
    rows = pin(derive_and_guard(X.fact(spark, sf)).select("tripid", "service_type", "temp_band").dropDuplicates(["tripid", "service_type"]))
    text = plan(carve_holdout(rows, key=["tripid", "service_type"]))
    assert "Window" not in text and "Exchange hashpartitioning" not in text and "BroadcastHashJoin" in text


def test_keep_first_combines_before_the_shuffle(spark, sf):
    text = plan(QUERIES["c04_dedup_keep_first"](spark, sf))
    assert "partial_min" in text and "Window" not in text
