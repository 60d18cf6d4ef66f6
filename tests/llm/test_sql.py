"""Operators against their DuckDB SQL, over the whole tables."""

import os

import pytest

from conftest import SF_SMALL
from oracle_compare import compare, duck
from starloom.llm.registry import oracle_sql, queries

SF = os.environ.get("STARLOOM_ORACLE_SF", SF_SMALL)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_operator_matches_its_sql(spark, name):
    r = compare(queries()[name](spark, SF), duck(SF), oracle_sql()[name])
    assert r["cols_match"], (r["spark_cols"], r["oracle_cols"])
    assert r["spark_rows"] == r["oracle_rows"]
    assert r["values_match"], r["diff"]
