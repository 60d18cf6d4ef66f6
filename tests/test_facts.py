"""Fact extraction, incremental refresh, late facts (scenario rows)."""

import datetime as dt
from decimal import Decimal as Dec

from pyspark.sql import functions as F

import scenario_data as sd
from starloom.operators import audit as A
from starloom.operators import facts as FX
from starloom.operators import load as L
from starloom.plans import loads


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def _initial(spark):
    base = sd.make_sources(spark)
    full = sd.make_sources(spark, salestransaction=sd.BASE_SALES + sd.NEW_SALES,
                           soldvia=sd.BASE_SOLD + sd.NEW_SOLD,
                           rentaltransaction=sd.BASE_RENTALS + sd.NEW_RENTALS,
                           rentvia=sd.BASE_RENTVIA + sd.NEW_RENTVIA)
    dims = loads.build_dimensions(full)
    fact = loads.initial_fact_load(base, dims, sd.INITIAL_AS_OF)
    return base, full, dims, fact


def test_extract_sales_and_rentals_revenue(spark):
    _, full, _, _ = _initial(spark)
    inter = FX.intermediate_fact(full, dt.date(2025, 3, 21), bounded=True)
    got = _rows(inter, "TID", "ProductId", "RevenueType", "UnitSolds", "RevenueGenerated")
    assert got == [
        ("ABC", "1X2", "Sales", 2, Dec("200.00")), ("ABC", "2X4", "Sales", 5, Dec("100.00")),
        ("CDE", "1X2", "Sales", 3, Dec("300.00")), ("CDE", "1X3", "Sales", 6, Dec("90.00")),
        ("FGH", "1X1", "RentalDaily", 0, Dec("50.00")), ("FGH", "2X2", "RentalWeekly", 0, Dec("600.00")),
    ]


def test_high_water_mark_and_empty_fact(spark):
    _, full, dims, fact = _initial(spark)
    assert FX.high_water_mark(fact).first()[0] == dt.date(2025, 3, 21)
    empty = fact.limit(0)
    assert FX.high_water_mark(empty).first()[0] is None
    # a NULL mark extracts nothing
    assert loads.daily_refresh(full, dims, empty, sd.DAILY_AS_OF).count() == 0


def test_daily_refresh(spark):
    _, full, dims, fact = _initial(spark)
    new = loads.daily_refresh(full, dims, fact, sd.DAILY_AS_OF)
    assert _rows(new, "TID", "RevenueType") == [("ABC", "Sales"), ("ABC", "Sales"), ("CDE", "Sales"),
                                                ("CDE", "Sales"), ("FGH", "RentalDaily"), ("FGH", "RentalWeekly")]
    assert {r.f_loaded for r in new.collect()} == {False}
    assert {r.ExtractionTimestamp for r in new.collect()} == {sd.DAILY_AS_OF}
    ds = fact.unionByName(new)
    published = L.publish_unloaded(ds, "f_loaded", ["TID", "RevenueType"])
    assert published.count() == 6
    assert L.mark_loaded(ds, "f_loaded").filter(~F.col("f_loaded")).count() == 0


def test_rerun_adds_nothing(spark):
    _, full, dims, fact = _initial(spark)
    new = loads.daily_refresh(full, dims, fact, sd.DAILY_AS_OF)
    state = fact.unionByName(L.mark_loaded(new, "f_loaded"))
    # the mark moved to the refresh date; the rows of the 26th are not re-extracted
    again = loads.daily_refresh(full, dims, state, sd.DAILY_AS_OF)
    assert again.count() == 0


def test_future_dated_transaction_not_loaded_twice(spark):
    """A transaction dated after the refresh date is extracted once."""
    fut = [("FUT", "6-7-888", "S4", dt.date(2025, 3, 30))]
    full = sd.make_sources(spark, salestransaction=sd.BASE_SALES + sd.NEW_SALES + fut,
                           soldvia=sd.BASE_SOLD + sd.NEW_SOLD + [("1X3", "FUT", 1)])
    _, _, dims, fact = _initial(spark)
    dims = loads.build_dimensions(full)
    first = loads.daily_refresh(full, dims, fact, sd.DAILY_AS_OF)
    state = fact.unionByName(L.mark_loaded(first, "f_loaded"))
    second = loads.daily_refresh(full, dims, state, dt.datetime(2025, 3, 28, 2))
    assert first.filter(F.col("TID") == "FUT").count() == 1
    assert second.filter(F.col("TID") == "FUT").count() == 0


def test_late_facts(spark):
    _, full, dims, fact = _initial(spark)
    state = fact.unionByName(L.mark_loaded(loads.daily_refresh(full, dims, fact, sd.DAILY_AS_OF), "f_loaded"))
    with_late = full.replace(
        salestransaction=full.salestransaction.unionByName(spark.createDataFrame(sd.LATE_SALES, full.salestransaction.schema)),
        soldvia=full.soldvia.unionByName(spark.createDataFrame(sd.LATE_SOLD, full.soldvia.schema)),
        rentaltransaction=full.rentaltransaction.unionByName(
            spark.createDataFrame(sd.LATE_RENTALS, full.rentaltransaction.schema)),
        rentvia=full.rentvia.unionByName(spark.createDataFrame(sd.LATE_RENTVIA, full.rentvia.schema)))
    late = loads.late_fact_refresh(with_late, dims, state, sd.DAILY_AS_OF)
    assert _rows(late, "TID", "RevenueType") == [("NEWRT", "RentalDaily"), ("NEWRT", "RentalWeekly"),
                                                 ("NEWST", "Sales")]


def test_late_line_of_loaded_transaction_stays_lost(spark):
    """Transaction grain: an extra line of an already-loaded TID is not recovered."""
    _, full, dims, fact = _initial(spark)
    extra = full.replace(soldvia=full.soldvia.unionByName(
        spark.createDataFrame([("1X3", "T1", 4)], full.soldvia.schema)))
    assert FX.late_facts(extra, fact).filter(F.col("TID") == "T1").count() == 0


def test_duplicate_source_keys_are_audited(spark):
    """The second-day inserts repeat (1X2, CDE)."""
    src = sd.make_sources(spark, soldvia=sd.BASE_SOLD + sd.NEW_SOLD + [("1X2", "CDE", 3)])
    r = A.primary_key_audit(src.soldvia, ["productid", "tid"]).first()
    assert (r.NumRows, r.NumKeys, r.DuplicatedKeys) == (7, 6, 1)


def test_rental_of_unknown_customer_drops_at_extract(spark):
    """Rentals need a known customer and store at extraction."""
    src = sd.make_sources(spark, rentaltransaction=sd.BASE_RENTALS + [("RX", "9-9-999", "S7", dt.date(2025, 3, 20))],
                          rentvia=sd.BASE_RENTVIA + [("1X1", "RX", "D", 1)])
    assert FX.extract_rentals(src).filter(F.col("TID") == "RX").count() == 0


def test_unresolved_facts_reports_drops(spark):
    src = sd.make_sources(spark, salestransaction=sd.BASE_SALES + [("SX", "9-9-999", "S4", dt.date(2025, 3, 20))],
                          soldvia=sd.BASE_SOLD + [("1X2", "SX", 1)])
    dims = loads.build_dimensions(sd.make_sources(spark))
    un = FX.unresolved_facts(FX.intermediate_fact(src), dims)
    assert _rows(un, "TID", "Reason") == [("SX", "customer")]
    assert loads.initial_fact_load(src, dims, sd.INITIAL_AS_OF).filter(F.col("TID") == "SX").count() == 0


def test_stamps_do_not_move_with_session_time_zone(spark):
    _, full, dims, fact = _initial(spark)
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        new = loads.daily_refresh(full, dims, fact, sd.DAILY_AS_OF)
        stamps = {r.ExtractionTimestamp for r in new.collect()}
        marks = FX.high_water_mark(fact).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert stamps == {sd.DAILY_AS_OF}
    assert marks == dt.date(2025, 3, 21)
