"""Type 2 history: detection, expiry, new versions, as-of lookup, and the
regressions D1-D4, D14 of the original script."""

import datetime as dt
from decimal import Decimal as Dec

from pyspark.sql import functions as F

import scenario_data as sd
from starloom import schema as S
from starloom.operators import dims as D
from starloom.operators import facts as FX
from starloom.operators import load as L
from starloom.operators import scd2
from starloom.plans import loads

OPEN = dt.date(1990, 1, 1)
CHG = dt.datetime(2025, 3, 23, 2)


def _dim(spark, src=None):
    src = src or sd.make_sources(spark)
    staged = D.load_columns(D.product_dimension(src), "PDloaded", dt.datetime(2025, 1, 1), True)
    return scd2.initialise(staged, OPEN)


def _edit(rows, pid, **chg):
    out = []
    for r in rows:
        if r[0] == pid:
            r = list(r)
            for idx, v in chg.items():
                r[int(idx[1:])] = v
            r = tuple(r)
        out.append(r)
    return out


def _changed_src(spark):
    p = _edit(sd.PRODUCT, "1X2", c2=Dec("200.00"))                   # price
    p = _edit(p, "1X3", c1="Solar Charger")                          # name
    p = _edit(p, "1X4", c1="Safe-B Helmet", c2=Dec("80.00"))         # name + price
    p = _edit(p, "4X2", c3="WL")                                     # vendor
    r = _edit(sd.RENTAL, "1X1", c5=Dec("75.00"))                     # weekly
    r = _edit(r, "2X2", c4=Dec("22.00"))                             # daily
    r = _edit(r, "3X3", c4=Dec("4.00"), c5=Dec("24.00"))             # both
    return sd.make_sources(spark, product=p, rentalproducts=r)


def test_detect_sales_and_rental_changes(spark):
    got = sorted(tuple(r) for r in scd2.detect_changes(_changed_src(spark), _dim(spark)).collect())
    assert got == [("1X1", "Rental"), ("1X2", "Sales"), ("1X3", "Sales"), ("1X4", "Sales"), ("2X2", "Rental"),
                   ("3X3", "Rental"), ("4X2", "Sales")]


def test_apply_changes_versions(spark):
    dim = _dim(spark)
    out = scd2.apply_changes(_changed_src(spark), dim, CHG)
    rows = {(r.ProductId, r.ProductType, r.CurrentStatus): r for r in out.collect()}
    assert out.count() == 9 + 7
    old, new = rows[("1X2", "Sales", "N")], rows[("1X2", "Sales", "C")]
    assert old.DVU == dt.date(2025, 3, 22) and old.ProductSalesPrice == Dec("100.00")
    assert new.DVF == dt.date(2025, 3, 23) and new.DVU == S.OPEN_DVU and new.ProductSalesPrice == Dec("200.00")
    assert new.Product_Key > 9 and new.PDloaded is False
    assert rows[("4X2", "Sales", "C")].VendorId == "WL"
    assert rows[("4X2", "Sales", "C")].Vendorname == "Wilderness Limited"
    # keys stay unique
    assert out.select("Product_Key").distinct().count() == out.count()


def test_sale_only_change_keeps_rental_current(spark):
    """1X4 is in both lists; a sales edit must not close its rental row."""
    out = scd2.apply_changes(_changed_src(spark), _dim(spark), CHG)
    r = out.filter((F.col("ProductId") == "1X4") & (F.col("ProductType") == "Rental")).collect()
    assert [(x.CurrentStatus, x.DVU) for x in r] == [("C", S.OPEN_DVU)]


def test_second_round_expires_only_current_rows(spark):
    """A later change closes the current row only; old versions keep their DVU."""
    src1 = _changed_src(spark)
    dim1 = scd2.apply_changes(src1, _dim(spark), CHG)
    src2 = sd.make_sources(spark, product=_edit(_edit(sd.PRODUCT, "1X2", c2=Dec("250.00")), "1X3", c1="Solar Charger"),
                           rentalproducts=src1.rentalproducts.collect())
    chg2 = dt.datetime(2025, 3, 25, 2)
    dim2 = scd2.apply_changes(src2, dim1, chg2)
    v = sorted((r.DVF, r.DVU, r.CurrentStatus) for r in
               dim2.filter((F.col("ProductId") == "1X2") & (F.col("ProductType") == "Sales")).collect())
    assert v == [(OPEN, dt.date(2025, 3, 22), "N"), (dt.date(2025, 3, 23), dt.date(2025, 3, 24), "N"),
                 (dt.date(2025, 3, 25), S.OPEN_DVU, "C")]
    # unchanged since the first round: no new version
    assert dim2.filter(F.col("ProductId") == "1X3").count() == 2


def test_two_changes_in_one_day(spark):
    """The first new row of the day ends before it starts and never matches as-of."""
    dim1 = scd2.apply_changes(_changed_src(spark), _dim(spark), CHG)
    src2 = sd.make_sources(spark, product=_edit(sd.PRODUCT, "1X2", c2=Dec("300.00")))
    dim2 = scd2.apply_changes(src2, dim1, CHG)
    mid = dim2.filter((F.col("ProductId") == "1X2") & (F.col("DVF") == CHG.date())
                      & (F.col("CurrentStatus") == "N")).first()
    assert mid.DVU < mid.DVF
    _assert_intervals(dim2)


def _assert_intervals(dim):
    bad = dim.groupBy("ProductId", "ProductType").agg(
        F.count(F.when(F.col("CurrentStatus") == "C", 1)).alias("cur")).filter(F.col("cur") != 1)
    assert bad.count() == 0
    d = dim.filter(F.col("DVF") <= F.col("DVU")).alias("a").join(
        dim.filter(F.col("DVF") <= F.col("DVU")).alias("b"),
        (F.col("a.ProductId") == F.col("b.ProductId")) & (F.col("a.ProductType") == F.col("b.ProductType"))
        & (F.col("a.Product_Key") < F.col("b.Product_Key"))
        & (F.col("a.DVF") <= F.col("b.DVU")) & (F.col("b.DVF") <= F.col("a.DVU")))
    assert d.count() == 0


def test_as_of_lookup_vs_literal(spark):
    """The literal lookup meets every version; as-of meets one."""
    src = sd.make_sources(spark, salestransaction=sd.BASE_SALES + sd.NEW_SALES, soldvia=sd.BASE_SOLD + sd.NEW_SOLD)
    dims = loads.build_dimensions(src)
    staged = scd2.initialise(D.load_columns(dims.product, "PDloaded", dt.datetime(2025, 1, 1), True), OPEN)
    chg = sd.make_sources(spark, product=_edit(sd.PRODUCT, "1X2", c2=Dec("200.00")))
    after = scd2.apply_changes(chg, staged, CHG)
    d2 = FX.Dimensions(dims.customer, dims.store, after, dims.calendar)
    inter = FX.extract_sales(src)
    lit = FX.resolve_fact_keys(inter, d2, CHG, as_of_lookup=False)
    asof = FX.resolve_fact_keys(inter, d2, CHG)
    n_1x2 = inter.filter(F.col("ProductId") == "1X2").count()
    assert lit.count() == inter.count() + n_1x2
    assert asof.count() == inter.count()
    keys = {r.TID: r.Product_Key for r in asof.join(after.select("Product_Key", "ProductId"), "Product_Key")
            .filter(F.col("ProductId") == "1X2").collect()}
    new_key = after.filter((F.col("ProductId") == "1X2") & (F.col("CurrentStatus") == "C")).first().Product_Key
    assert keys["T1"] != new_key and keys["ABC"] == new_key and keys["CDE"] == new_key


def test_upsert_replaces_by_key(spark):
    dim = _dim(spark)
    after = scd2.apply_changes(_changed_src(spark), dim, CHG)
    dw = dim.filter(F.col("ProductId") != "3X3")  # the DW lacks a row: the upsert adds it
    out = L.upsert(dw, after, ["Product_Key"])
    assert out.count() == after.count()
    assert out.filter(F.col("CurrentStatus") == "N").count() == 7
    # a row that only the target has stays as it is
    kept = L.upsert(dim, after.filter(F.col("ProductId") != "3X3"), ["Product_Key"]).filter(F.col("ProductId") == "3X3")
    assert kept.exceptAll(dim.filter(F.col("ProductId") == "3X3")).count() == 0 and kept.count() == 1


def test_price_comparison(spark):
    """The original's check after one price edit: exactly one row differs; the
    all-rows forms list every product of a type."""
    dim = _dim(spark)
    src = sd.make_sources(spark, product=_edit(sd.PRODUCT, "1X2", c2=Dec("200.00")))
    pair = [("productprice", "ProductSalesPrice")]
    one = scd2.price_comparison(D.product_sales_rows(src), dim, "Sales", pair, changed_only=True).collect()
    assert [(r.ProductId, r.productprice, r.ProductSalesPrice) for r in one] == [("1X2", Dec("200.00"), Dec("100.00"))]
    assert scd2.price_comparison(D.product_sales_rows(src), dim, "Sales", pair).count() == len(sd.PRODUCT)
    rentals = [("d", "ProductDailyRentalPrice"), ("w", "ProductWeeklyRental")]
    assert scd2.price_comparison(D.product_rental_rows(src), dim, "Rental", rentals).count() == len(sd.RENTAL)


def test_lines_older_than_the_first_version(spark):
    """A line dated before its product's registration takes the first version;
    only a line after the last version's end has none."""
    src = sd.make_sources(spark)
    dims = loads.build_dimensions(src)
    staged = scd2.initialise(D.load_columns(dims.product, "PDloaded", dt.datetime(2025, 1, 1), True),
                             dt.date(2025, 3, 20))
    d2 = FX.Dimensions(dims.customer, dims.store, staged, dims.calendar)
    inter = FX.intermediate_fact(src)
    assert FX.unresolved_facts(inter, d2).count() == 0
    assert FX.resolve_fact_keys(inter, d2, CHG).count() == 3
    ended = staged.withColumn("DVU", F.lit(dt.date(2025, 3, 19)))
    d3 = FX.Dimensions(dims.customer, dims.store, ended, dims.calendar)
    # T2 is dated 2025-03-19; T1 and R1 the day after
    assert sorted((r.TID, r.Reason) for r in FX.unresolved_facts(inter, d3).collect()) == [("R1", "product"), ("T1", "product")]
    assert [r.TID for r in FX.resolve_fact_keys(inter, d3, CHG).collect()] == ["T2"]


def test_customer_and_store_versions_by_date(spark):
    """A moved customer and a changed store have two versions; a line takes one."""
    src = sd.make_sources(spark, salestransaction=sd.BASE_SALES + sd.NEW_SALES, soldvia=sd.BASE_SOLD + sd.NEW_SOLD)
    dims = loads.build_dimensions(src)
    cust = scd2.initialise(D.load_columns(dims.customer, "Cloaded", dt.datetime(2025, 1, 1), True), OPEN)
    store = scd2.initialise(D.load_columns(dims.store, "Sloaded", dt.datetime(2025, 1, 1), True), OPEN)
    moved = D.customer_rows(src).withColumn("CustomerZip", F.lit("99999"))
    cust = scd2.apply_generic(moved, cust, CHG, ["CustomerID"], ["CustomerZip"], D.CUSTOMER_ORDER, "Customer_Key", "Cloaded")
    rezoned = D.store_rows(src).withColumn("StoreZip", F.lit("88888"))
    store = scd2.apply_generic(rezoned, store, CHG, ["StoreID"], ["StoreZip"], D.STORE_ORDER, "Store_Key", "Sloaded")
    d2 = FX.Dimensions(cust, store, dims.product, dims.calendar)
    inter = FX.intermediate_fact(src)
    out = FX.resolve_fact_keys(inter, d2, CHG).join(dims.calendar, "Calendar_Key").collect()
    assert len(out) == inter.count()
    n, m = len(sd.CUSTOMER), len(sd.STORE)
    assert all((r.Customer_Key > n) == (r.FullDate >= CHG.date()) and (r.Store_Key > m) == (r.FullDate >= CHG.date()) for r in out)


def test_untracked_changes_create_no_version(spark):
    """A category id or a vendor name change is not tracked by default."""
    p = _edit(sd.PRODUCT, "1X2", c4="FW")                               # category id
    vendors = [("OA", "Outdoor Adv. Ltd")] + sd.VENDOR[1:]               # vendor name
    src = sd.make_sources(spark, product=p, vendor=vendors)
    assert scd2.detect_changes(src, _dim(spark)).count() == 0


def test_type2_for_customers(spark):
    """The same steps serve other dimensions via key and tracked columns."""
    src0 = sd.make_sources(spark)
    dim = scd2.initialise(D.load_columns(D.customer_dimension(src0), "Cloaded", dt.datetime(2025, 1, 1), True), OPEN)
    moved = [(c, n, "99999" if c == "3-4-555" else z) for c, n, z in sd.CUSTOMER]
    rows = D.customer_rows(sd.make_sources(spark, customer=moved))
    out = scd2.apply_generic(rows, dim, CHG, ["CustomerID"], ["CustomerName", "CustomerZip"], D.CUSTOMER_ORDER,
                             "Customer_Key", "Cloaded")
    bob = sorted((r.CustomerZip, r.CurrentStatus, r.Customer_Key) for r in
                 out.filter(F.col("CustomerID") == "3-4-555").collect())
    assert bob == [("14001", "N", 2), ("99999", "C", 5)]
    assert out.count() == 5
