"""Snapshot and roll-up marts on the scenario rows."""

from decimal import Decimal as Dec

import scenario_data as sd
from starloom.config import Params
from starloom.operators import marts as M
from starloom.plans import loads


def _fact(spark):
    src = sd.make_sources(spark, salestransaction=sd.BASE_SALES + sd.NEW_SALES, soldvia=sd.BASE_SOLD + sd.NEW_SOLD,
                          rentaltransaction=sd.BASE_RENTALS + sd.NEW_RENTALS, rentvia=sd.BASE_RENTVIA + sd.NEW_RENTVIA)
    dims = loads.build_dimensions(src)
    return loads.initial_fact_load(src, dims, sd.DAILY_AS_OF), dims


def test_daily_store_snapshot(spark):
    fact, dims = _fact(spark)
    snap = M.daily_store_snapshot(fact, dims, Params(tracked_category="Footwear"))
    cal = {r.Calendar_Key: r.FullDate for r in dims.calendar.collect()}
    st = {r.Store_Key: r.StoreID for r in dims.store.collect()}
    got = {(cal[r.Calendar_Key].isoformat(), st[r.Store_Key]): r for r in snap.collect()}
    abc = got[("2025-03-25", "S10")]
    # ABC: 2 lines, 200 + 100; footwear 100 (Shoe); local: store 14000 vs customer 13677 → no
    assert (abc.TotalUnitSold, abc.TotalRevenueGenerated, abc.TotalNumberOfTransactions) == (7, Dec("300.00"), 1)
    assert abc.AverageRevenueGenerated == Dec("150.00")
    assert (abc.TotalFootwearRevenue, abc.NumberOfHVTransaction, abc.TotalLocalRevenue) == (Dec("100.00"), 1, Dec("0.00"))
    cde = got[("2025-03-26", "S4")]
    # CDE: 300 + 90; customer 13699 vs store 13676 → local
    assert (cde.TotalRevenueGenerated, cde.TotalLocalRevenue, cde.NumberOfHVTransaction) == (
        Dec("390.00"), Dec("390.00"), 1)
    assert cde.AverageRevenueGenerated == Dec("195.00")
    t1 = got[("2025-03-20", "S4")]
    # One line of 100: not above 100 (strict)
    assert (t1.NumberOfHVTransaction, t1.TotalFootwearRevenue) == (0, Dec("0.00"))


def test_average_half_up_exact(spark):
    from starloom.functions import avg_half_up
    df = spark.createDataFrame([(Dec("0.05"), 2), (Dec("0.01"), 2), (Dec("10.00"), 3), (Dec("2.00"), 3), (Dec("-0.07"), 3), (Dec("-0.05"), 2), (None, 0)],
                               "t decimal(18,2), n long")
    got = [r[0] for r in df.select(avg_half_up("t", "n")).collect()]
    assert got == [Dec("0.03"), Dec("0.01"), Dec("3.33"), Dec("0.67"), Dec("-0.02"), Dec("-0.03"), None]


def test_helper_marts_match_snapshot(spark):
    fact, dims = _fact(spark)
    p = Params(tracked_category="Footwear")
    snap = {(r.Calendar_Key, r.Store_Key): r for r in M.daily_store_snapshot(fact, dims, p).collect()}
    for r in M.footwear_revenue(fact, dims.product, p.tracked_category).collect():
        assert snap[(r.Calendar_Key, r.Store_Key)].TotalFootwearRevenue == r.TotalFootwearRevenue
    for r in M.hv_transactions(fact, p.high_value).collect():
        assert snap[(r.Calendar_Key, r.Store_Key)].NumberOfHVTransaction == r.HVTransactionCount
    for r in M.local_revenue(fact, dims, p.zip_prefix).collect():
        assert snap[(r.Calendar_Key, r.Store_Key)].TotalLocalRevenue == r.TotalLocalRevenue
