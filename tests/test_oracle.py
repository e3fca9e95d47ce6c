"""Every registered query against its DuckDB oracle (the driver's check),
on the smallest scale so the suite stays quick.  `oracle_harness.py` runs
the same comparison at sf0.01 by hand."""

import os

import pytest

from conftest import SMALL
from oracle_harness import compare, duck

import __spark_entry__ as contract
from tidemark.plans.catalog import QUERIES

NAMES = sorted(QUERIES)      # optional operators bring their own tests


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables not present")
@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, name, SMALL, con)
    if res.get("oracle") == "none":
        assert res["spark_rows"] >= 0
        return
    assert res["cols_ok"], res
    assert res["types_ok"], res
    assert res["ok"], res


def test_every_query_has_doc_and_oracle_or_reason():
    sql = contract.oracle_sql()
    for name, fn in contract.queries().items():
        assert fn.__doc__, name
        if name not in QUERIES:
            continue
        assert name in sql, name


def test_entry_smoke(spark):
    df = contract.entry(spark)
    assert set(df.columns) == {"window_end", "rank", "item_id", "click_count"}
    assert df.count() > 0
