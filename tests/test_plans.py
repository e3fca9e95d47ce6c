"""Physical-plan properties of registered queries: filters reach the Parquet
scan, only needed columns are read, shuffles are where they should be."""

import os
import re

import pytest

from conftest import SMALL

import __spark_entry__ as contract

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables not present")


def _plan(spark, name):
    df = contract.queries()[name](spark, SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


def _scans(plan):
    return [l for l in plan.splitlines() if "FileScan parquet" in l]


def test_pv_pushes_filter_and_prunes_columns(spark):
    plan = _plan(spark, "pv_tumbling")
    (scan,) = _scans(plan)
    assert "EqualTo(event_type,view)" in scan
    assert re.search(r"ReadSchema: struct<ts:timestamp_ntz,event_type:string>", scan)
    assert plan.count("Exchange") == 1          # one shuffle, after partial aggregation


def test_top_items_limits_before_the_exchange(spark):
    plan = _plan(spark, "top_items")
    assert plan.count("WindowGroupLimit") == 2  # partial (map side) and final


def test_order_status_single_shuffle(spark):
    plan = _plan(spark, "order_status")
    assert plan.count("Exchange") == 1
    for scan in _scans(plan):
        assert "o_totalprice" not in scan and "l_quantity" not in scan


def test_interval_join_pushes_both_sides(spark):
    scans = _scans(_plan(spark, "interval_join"))
    assert any("EqualTo(event_type,click)" in s for s in scans)
    assert any("EqualTo(event_type,purchase)" in s for s in scans)
    assert all("props" not in s.split("ReadSchema")[1] for s in scans)


def test_top_pages_expands_after_the_exchange(spark):
    plan = _plan(spark, "top_pages")
    assert plan.count("Exchange hashpartitioning") == 3     # slices, blocks, window ends
    ends, rest = plan.split("Generate explode(sequence", 1)  # plans are printed from the result down
    assert "Exchange hashpartitioning(__block" in rest and "Exchange hashpartitioning(__block" not in ends
