"""Plan properties of the headline queries (final adaptive plans)."""

import re

import pytest

from conftest import SF_SMALL
from starloom.plans.queries import queries

Q = queries()
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"]


def _plan(spark, name):
    df = Q[name](spark, SF_SMALL)
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["daily_store_snapshot", "daily_refresh_facts", "late_fact_refresh",
                                  "scd2_product_dimension", "resolve_fact_keys_asof",
                                  "one_way_revenue_by_category"])
def test_no_pair_joins_or_python(spark, name):
    plan = _plan(spark, name)
    for op in FORBIDDEN:
        assert op not in plan, op


def test_snapshot_has_no_expand_and_narrow_scans(spark):
    plan = _plan(spark, "daily_store_snapshot")
    assert "Expand" not in plan
    schemas = re.findall(r"lineitem\.parquet.*?ReadSchema: struct<([^>]*)>", plan)
    assert schemas
    for schema in schemas:
        assert len(schema.split(",")) <= 4, schema
