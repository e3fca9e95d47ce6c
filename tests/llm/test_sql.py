"""Registered queries against their DuckDB SQL at sf0.01."""

import pytest

from conftest import MEDIUM
from oracle_harness import compare, duck
from tidemark.llm.queries import QUERIES
from tidemark.llm.sql import SQL


@pytest.fixture(scope="module")
def con():
    return duck(MEDIUM)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, name):
    res = compare(spark, name, MEDIUM, con)
    assert res["types_ok"] and res["cols_ok"] and res["ok"], res


def test_every_operator_is_registered_once():
    import __spark_entry__ as contract
    ops = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert ops == list(range(1, len(ops) + 1))
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert set(SQL) <= set(contract.oracle_sql())
