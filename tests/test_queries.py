"""Every registered query against its SQL at the smallest scale."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry_points  # noqa: E402
from check_queries import compare, connect  # noqa: E402
from meterline.registry import CHECK_SQL, QUERIES  # noqa: E402

# Fitted tree ensembles take longest; they have their own smaller tests.
SLOW = {"m15_run_sweep", "m17_stack", "m25_ablation", "m10_cross_validate_gbt_encoded"}


@pytest.fixture(scope="module")
def db(sf):
    return connect(sf)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SLOW])
def test_query_matches_sql(spark, db, sf, name):
    assert compare(spark, db, name, sf) == ""


def test_entry_points(spark):
    assert entry_points.entry(spark).count() > 0
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert set(CHECK_SQL) <= set(QUERIES)
