"""Whole-pipeline properties on the fixture tables (sf0.001)."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from starloom import schema as S
from starloom.operators import load as L
from starloom.plans.scenario import Warehouse

MEASURES = S.FACT_KEY + ["RevenueGenerated", "UnitSolds"]


def test_daily_plus_late_equals_full_load(spark):
    w = Warehouse(spark, SF_SMALL)
    loaded = w.after_daily.unionByName(L.mark_loaded(w.late_new, "f_loaded")).select(*MEASURES)
    full = w.fact.select(*MEASURES)
    assert loaded.count() == full.count() == 4431
    assert loaded.exceptAll(full).count() == 0 and full.exceptAll(loaded).count() == 0
    parts = (w.initial_fact.count(), w.daily_new.count(), w.late_new.count())
    assert parts == (4022, 370, 39)


def test_rerun_of_daily_refresh_is_empty(spark):
    from starloom.plans import loads
    w = Warehouse(spark, SF_SMALL)
    again = loads.daily_refresh(w.src, w.dims, w.after_daily.unionByName(w.late_new), w.p.refresh_as_of, w.mark)
    assert again.count() == 0


def test_scd_intervals_on_fixtures(spark):
    w = Warehouse(spark, SF_SMALL)
    dim = w.product_after_scd
    per = dim.groupBy("ProductId", "ProductType").agg(
        F.count(F.when(F.col("CurrentStatus") == "C", 1)).alias("cur"), F.count("*").alias("n"))
    assert per.filter(F.col("cur") != 1).count() == 0
    assert dim.count() == 300 + 29 + 15
    assert dim.select("Product_Key").distinct().count() == dim.count()


def test_fixture_counts(spark):
    w = Warehouse(spark, SF_SMALL)
    assert w.changed_products.groupBy("ProductType").count().orderBy("ProductType").collect() == [
        ("Rental", 15), ("Sales", 29)]
    assert w.fact.filter(F.col("RevenueGenerated") > 100).count() == 4359
