"""States that several steps read are computed once, and a bounded extraction
sums only the lines it keeps (rows made here)."""

import datetime as dt
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from starloom.operators import facts as FX
from starloom.plans.queries import queries
from starloom.plans.scenario import Warehouse
from starloom.sources import fixtures

Q = queries()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    day = lambda k: dt.datetime(1995, 1, 2) + dt.timedelta(days=60 * k)
    made = {
        "region": ("r_regionkey int, r_name string", [(0, "NORTH"), (1, "SOUTH")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "A", 0), (1, "B", 1)]),
        "customer": ("c_custkey long, c_name string, c_nationkey int", [(k, f"c{k}", k % 2) for k in range(5)]),
        "supplier": ("s_suppkey long, s_name string, s_nationkey int", [(k, f"s{k}", k % 2) for k in range(3)]),
        "part": ("p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
                 [(k, f"p{k}", f"Brand#{k % 3}", ("PROMO", "ECONOMY")[k % 2], k, 100.0 + 90 * k) for k in range(12)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz",
                   [(k, k % 5, "FOP"[k % 3], day(k % 40)) for k in range(200)]),
        "lineitem": ("l_orderkey long, l_partkey long, l_quantity double, l_linestatus string",
                     [(k, (k + j) % 12, float(j + 1), "OF"[j % 2]) for k in range(200) for j in range(4)]),
    }
    for name, (schema, rows) in made.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{d}/{name}.parquet")
    return d


def _scans(df) -> int:
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return len(re.findall(r"l_orderkey#\d+L?,.*parquet", plan))


@pytest.mark.parametrize("name", ["revenue_rollups", "daily_store_snapshot_incremental", "daily_store_snapshot_update_joins"])
def test_marts_that_read_the_fact_often_extract_it_once(spark, tables, name):
    assert _scans(Q[name](spark, tables)) == 0  # lines are read when the fact is written


@pytest.mark.parametrize("name", ["late_facts", "late_fact_refresh", "late_refresh_after_scd2"])
def test_late_steps_read_the_stored_daily_load(spark, tables, name):
    assert _scans(Q[name](spark, tables)) == 2  # sold and rented lines of the late transactions


@pytest.mark.parametrize("name", ["audit_fact_pk", "audit_fact_orphans"])
def test_audits_read_stored_loads(spark, tables, name):
    assert _scans(Q[name](spark, tables)) == 0


def test_published_fact_is_the_fact(spark, tables):
    w = Warehouse(spark, tables)
    cols = w.published_fact.columns
    assert w.published_fact.dtypes == w.fact.select(*cols).dtypes
    assert sorted(map(str, w.published_fact.collect())) == sorted(map(str, w.fact.select(*cols).collect())) != []


def test_bounded_extraction_narrows_lines_before_they_are_summed(spark, tables):
    src, mark = Warehouse(spark, tables).src, dt.date(1998, 1, 1)
    got = FX.intermediate_fact(src, mark, bounded=True)
    want = [r for r in FX.intermediate_fact(src).collect() if r.FullDate > mark]
    assert sorted(map(str, got.collect())) == sorted(map(str, want)) != []
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    below = [part.split("l_orderkey")[0] for part in plan.split("Aggregate [tid")[1:]]
    assert below and all("1998-01-01" in part or part.count("LeftSemi") == 2 for part in below), plan


def test_carried_lookup_extracts_the_lines_once(spark, tables):
    assert _scans(Q["resolve_fact_keys_carried"](spark, tables)) == 0  # lines are read when they are written


def test_parts_grow_with_the_lines(spark):
    assert fixtures.transaction_parts(spark, 0) is None and fixtures.transaction_parts(spark, 3_600_000) is None
    assert fixtures.transaction_parts(spark, 36_000_000) == 72
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        assert [fixtures.transaction_parts(spark, n * 36_000_000) for n in (1, 6)] == [200, 432]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_many_lines_are_dealt_out_however_many_there_are(spark, tables, monkeypatch):
    """Parts of a set number, which AQE leaves as they are: no task gets more than
    its share of the lines, and the lines stay."""
    of = lambda df: df.withColumn("_part", F.spark_partition_id()).collect()
    row = lambda r: str(r.asDict() | {"_part": 0})
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = of(FX.extract_sales(Warehouse(spark, tables).src))
        monkeypatch.setattr(fixtures, "LINES_PER_TASK", 40)
        src = Warehouse(spark, tables).src
        assert [src.soldvia.rdd.getNumPartitions(), src.rentvia.rdd.getNumPartitions()] == [20, 21]
        sold, rented = of(src.soldvia), of(src.rentvia)
        assert sorted(map(row, of(FX.extract_sales(src)))) == sorted(map(row, few)) != []
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert max(Counter(r._part for r in sold).values()) < len(sold) / 4
    assert max(Counter(r._part for r in rented).values()) < len(rented) / 4
