"""Every registered query against its DuckDB SQL (t2 tier).

Runs on sf0.001 by default; set STARLOOM_ORACLE_SF=/root/testdata/sf0.01
for the driver's scale."""

import os

import pytest

from conftest import SF_SMALL
from oracle_compare import compare, duck
from starloom.plans.oracle import oracle_sql
from starloom.plans.queries import queries

SF = os.environ.get("STARLOOM_ORACLE_SF", SF_SMALL)
QUERIES = queries()
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(QUERIES[name](spark, SF), con, SQL[name])
    assert r["cols_match"], (r["spark_cols"], r["oracle_cols"])
    assert r["spark_rows"] == r["oracle_rows"]
    assert r["values_match"], r["diff"]
