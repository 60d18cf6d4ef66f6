"""What the loads leave on disk: a step that is written leaves its table, not its
shuffle files (rows made in test_shared_steps)."""

import time
from pathlib import Path

import pytest
from test_shared_steps import _scans, tables  # noqa: F401

from starloom.operators import dims as D
from starloom.operators import facts as FX
from starloom.plans.queries import queries
from starloom.plans.scenario import SHUFFLE_CLEANUP, Warehouse


def _shuffle_files(spark) -> set[Path]:
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in dirs for f in Path(d.getPath()).rglob("shuffle_*")}


def _left(spark, before: set[Path]) -> set[Path]:
    """New shuffle files, when Spark has had time to remove them."""
    for _ in range(50):
        if not (new := _shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return new


@pytest.fixture
def w(spark, tables):  # noqa: F811
    made = Warehouse(spark, tables)
    assert made.src and made.base_src and made.dims
    return made


def test_initial_load_leaves_no_shuffle_files(spark, w):
    before = _shuffle_files(spark)
    assert w.initial_fact
    assert not _left(spark, before)


def test_daily_load_leaves_no_shuffle_files(spark, w):
    assert w.initial_fact and w.mark is not None
    before = _shuffle_files(spark)
    assert w.after_daily
    assert not _left(spark, before)


def test_late_load_leaves_no_shuffle_files(spark, w):
    assert w.after_daily
    before = _shuffle_files(spark)
    assert w.planted_fact()
    assert not _left(spark, before)


def test_prior_products_are_written_before_keys_are_assigned(spark, w, monkeypatch):
    seen = []
    build = D.product_dimension
    monkeypatch.setattr(D, "product_dimension", lambda src: seen.append(src) or build(src))
    assert w.prior_dim("product").count() > 0
    assert [(_scans(s.product), _scans(s.rentalproducts)) for s in seen] == [(0, 0)]
    m = w.master_at_start
    for name in ("product", "rentalproducts"):
        assert sorted(map(str, getattr(seen[0], name).collect())) == sorted(map(str, getattr(m, name).collect())) != []


def test_kept_lines_are_the_lines(w):
    kept = FX.intermediate_fact(w.src, keep=w.table)
    assert _scans(kept) == 0
    plain = FX.intermediate_fact(w.src)
    assert kept.dtypes == plain.dtypes
    assert sorted(map(str, kept.collect())) == sorted(map(str, plain.collect())) != []


def test_stores_have_their_own_size(w):
    stats = w.dims.store._jdf.queryExecution().optimizedPlan().stats()
    assert int(str(stats.sizeInBytes())) < 1_000_000  # not the product of the joined tables' sizes


def test_table_gives_the_setting_back(spark, w):
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    w.table(spark.range(3))
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == before
    with pytest.raises(Exception):
        w.table(spark.range(3).selectExpr("raise_error('no') AS x"))
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == before


def test_orphan_audit_reads_the_loads_by_column(spark, tables):  # noqa: F811
    audit = queries()["audit_fact_orphans"](spark, tables)
    assert any("/table-" in f for f in audit.inputFiles())
    plan = audit._jdf.queryExecution().optimizedPlan().toString()
    facts = [line for line in plan.splitlines() if "RevenueType#" in line and line.rstrip().endswith("parquet")]
    assert facts and plan.count("Project [Store_Key#") >= 2, plan
