"""Dimension builds, refreshes and surrogate keys."""

import datetime as dt
import random
from decimal import Decimal as Dec

from pyspark.sql import Window
from pyspark.sql import functions as F

import scenario_data as sd
from starloom import schema as S
from starloom.operators import dims as D
from starloom.operators.keys import assign_surrogate_keys

AS_OF = dt.datetime(2025, 4, 1, 2)


def test_keys_equal_global_row_number(spark):
    rnd = random.Random(7)
    vals = sorted({"".join(rnd.choice("ABCxyz019") for _ in range(rnd.randint(1, 6))) for _ in range(3000)})
    rnd.shuffle(vals)
    df = spark.createDataFrame([(v,) for v in vals], "nk string").repartition(5)
    got = assign_surrogate_keys(df, [("nk", True)], "k", base=100, num_partitions=7)
    want = df.withColumn("k", F.row_number().over(Window.orderBy("nk")) + 100)
    assert sorted(got.collect()) == sorted(want.collect())


def test_keys_descending_order_and_empty(spark):
    df = spark.createDataFrame([("a", "Sales"), ("a", "Rental"), ("b", "Sales")], "ProductId string, ProductType string")
    got = {(r.ProductId, r.ProductType): r.Product_Key
           for r in assign_surrogate_keys(df, D.PRODUCT_ORDER, "Product_Key").collect()}
    assert got == {("a", "Sales"): 1, ("b", "Sales"): 2, ("a", "Rental"): 3}
    assert assign_surrogate_keys(df.limit(0), D.PRODUCT_ORDER, "Product_Key").count() == 0


def test_product_dimension_both_lists(spark):
    dim = D.product_dimension(sd.make_sources(spark))
    rows = {(r.ProductId, r.ProductType): r for r in dim.collect()}
    assert len(rows) == 9
    h_sale, h_rent = rows[("1X4", "Sales")], rows[("1X4", "Rental")]
    assert h_sale.ProductSalesPrice is not None and h_sale.ProductDailyRentalPrice is None
    assert h_rent.ProductSalesPrice is None and h_rent.ProductWeeklyRental is not None
    assert sorted(r.Product_Key for r in rows.values()) == list(range(1, 10))


def test_refresh_product(spark):
    src0 = sd.make_sources(spark)
    dim = D.product_dimension(src0)
    src1 = sd.make_sources(spark, product=sd.PRODUCT + [("1Z1", "Bottle", Dec(34), "OA", "CY"),
                                                        ("2Z2", "COFFEE", Dec(10), "OA", "CY")],
                           rentalproducts=sd.RENTAL + [("F1D", "Ferrari", "OA", "EL", Dec(50), Dec(200)),
                                                       ("2Z2", "COFFEE", "WL", "CY", Dec(20), Dec(1000))])
    new = D.refresh_product_dimension(src1, dim, AS_OF)
    got = sorted((r.ProductId, r.ProductType, r.Product_Key) for r in new.collect())
    assert got == [("1Z1", "Sales", 10), ("2Z2", "Rental", 12), ("2Z2", "Sales", 11), ("F1D", "Rental", 13)]
    r = new.first()
    assert (r.PDloaded, r.ExtractionTimestamp, r.DVF, r.DVU, r.CurrentStatus) == (
        False, AS_OF, AS_OF.date(), S.OPEN_DVU, "C")
    # nothing new on a second run
    assert D.refresh_product_dimension(src1, dim.unionByName(new.select(*dim.columns)), AS_OF).count() == 0


def test_refresh_store_unknown_region_drops(spark):
    dim = D.store_dimension(sd.make_sources(spark))
    src1 = sd.make_sources(spark, store=sd.STORE + [("S15", "13676", "N"), ("S16", "13676", "C"),
                                                    ("S18", "19245", "I")])
    got = sorted((r.StoreID, r.Store_Key, r.RegionName) for r in D.refresh_store_dimension(src1, dim, AS_OF).collect())
    assert got == [("S15", 4, "North"), ("S16", 5, "Central")]


def test_refresh_customer_stamp_one_day_back(spark):
    dim = D.customer_dimension(sd.make_sources(spark))
    src1 = sd.make_sources(spark, customer=sd.CUSTOMER + [("9-6-666", "Connor", "13676"),
                                                          ("8-4-777", "Bedard", "13677")])
    new = D.refresh_customer_dimension(src1, dim, AS_OF)
    got = sorted((r.CustomerID, r.Customer_Key) for r in new.collect())
    assert got == [("8-4-777", 5), ("9-6-666", 6)]
    assert {r.ExtractionTimestamp for r in new.collect()} == {AS_OF - dt.timedelta(days=1)}


def test_calendar_bounds_from_data(spark):
    cal = D.calendar_dimension(sd.make_sources(spark))
    r = cal.agg(F.min("FullDate"), F.max("FullDate"), F.count("*"), F.min("Calendar_Key")).first()
    assert (r[0], r[1], r[2], r[3]) == (dt.date(2025, 1, 1), dt.date(2025, 12, 31), 365, 1)


def test_extend_calendar_keeps_keys(spark):
    src = sd.make_sources(spark)
    cal = D.calendar_dimension(src)
    later = sd.make_sources(spark, salestransaction=sd.BASE_SALES + [("TZ", "6-7-888", "S4", dt.date(2026, 2, 1))])
    grown = D.extend_calendar(later, cal)
    assert grown.count() == 365 + 365
    r = grown.filter(F.col("FullDate") == dt.date(2026, 1, 1)).first()
    assert r.Calendar_Key == 366
    assert D.extend_calendar(src, cal).count() == 365


def test_keys_exact_when_aqe_merges_ranges(spark):
    """Tiny advisory size: AQE merges some of the range partitions."""
    rnd = random.Random(11)
    vals = list({f"k{rnd.randint(0, 10**9):010d}" for _ in range(20000)})
    df = spark.createDataFrame([(v,) for v in vals], "nk string").repartition(6)
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
            "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
            "spark.sql.shuffle.partitions": "40"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        got = assign_surrogate_keys(df, [("nk", True)], "k", base=5)
        rows = got.collect()
        parts = got.select(F.spark_partition_id()).distinct().count()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    want = {v: i + 6 for i, v in enumerate(sorted(vals))}
    assert 1 < parts < 40
    assert {r.nk: r.k for r in rows} == want
