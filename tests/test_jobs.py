"""The persisted job layer: per-load directories, reruns, snapshots."""

import datetime as dt
import re
import tempfile
from decimal import Decimal as Dec

import pytest
from pyspark.sql import functions as F

import scenario_data as sd

from conftest import SF_SMALL
from starloom import jobs
from starloom import schema as S
from starloom.plans.scenario import Warehouse

KEY = S.FACT_KEY + ["RevenueGenerated", "UnitSolds"]


@pytest.fixture(scope="module")
def built(spark):
    root = tempfile.mkdtemp(prefix="starloom-wh-")
    w = Warehouse(spark, SF_SMALL)
    p = w.p
    r0 = jobs.run_initial_load(spark, w.base_src, root, p.initial_as_of, p.dims_loaded_at, p)
    r1 = jobs.run_daily_refresh(spark, w.src, root, p.refresh_as_of, "daily-1")
    r1b = jobs.run_daily_refresh(spark, w.src, root, p.refresh_as_of, "daily-1")  # rerun: replaced, not doubled
    r2 = jobs.run_late_fact_refresh(spark, w.src, root, p.refresh_as_of, "late-1")
    return root, w, (r0, r1, r1b, r2)


def test_loads_row_counts(built):
    _, _, (r0, r1, r1b, r2) = built
    assert (r0["rows"], r1["rows"], r1b["rows"], r2["rows"]) == (4022, 370, 370, 39)


def test_dw_fact_equals_full_load(spark, built):
    root, w, _ = built
    dw = jobs.Store(spark, root).read_fact("dw").select(*KEY)
    full = w.fact.select(*KEY)
    assert dw.count() == full.count()
    assert dw.exceptAll(full).count() == 0


def test_ds_flags_and_mark(spark, built):
    root, _, _ = built
    st = jobs.Store(spark, root)
    ds = st.read_fact("ds")
    assert ds.filter(~F.col("f_loaded")).count() == 0
    assert str(st.mark()) == "2001-09-01"


def test_rerun_of_older_load_refused(spark, built):
    root, w, _ = built
    with pytest.raises(RuntimeError, match="not the latest"):
        jobs.run_daily_refresh(spark, w.src, root, w.p.refresh_as_of, "daily-1")


def test_snapshot_job(spark, built):
    root, w, _ = built
    snap = jobs.run_daily_store_snapshot(spark, root, w.p)
    assert snap.count() == 1380
    audit = spark.read.parquet(f"{root}/marts/daily_store_snapshot_audit").collect()
    assert {r.Audit: r.Violations for r in audit} == {"duplicated_keys": 0, "orphan_Calendar_Key": 0, "orphan_Store_Key": 0}


def test_category_rollup_job(spark, built):
    root, w, _ = built
    from starloom.plans.queries import queries
    r = jobs.run_category_rollup(spark, root)
    want = queries()["one_way_revenue_by_category"](spark, SF_SMALL).count()
    assert r == {"categories": 6, "rows": want, "duplicated_keys": 0, "orphan_keys": 0}


def test_scd2_and_dimension_refresh_jobs(spark, built):
    root, w, _ = built
    r = jobs.run_scd2_products(spark, w.changed_src, root, w.p.scd_as_of, w.p)
    assert r == {"rows": 344, "new_versions": 44, "orphan_keys": 0}
    st = jobs.Store(spark, root)
    dw = st.read_dim("dw", "product")
    assert dw.count() == 344 and dw.filter(F.col("CurrentStatus") == "C").count() == 300
    assert jobs.run_dimension_refresh(spark, w.src, root, w.p.refresh_as_of, w.p) == {
        "customer": 0, "store": 0, "product": 0}


def test_dimension_refresh_job_adds_new_members(spark):
    from starloom.plans.queries import queries
    root = tempfile.mkdtemp(prefix="starloom-wh2-")
    w = Warehouse(spark, SF_SMALL)
    p = w.p
    jobs.run_initial_load(spark, w.master_at_start, root, p.initial_as_of, p.master_loaded_at, p)
    got = jobs.run_dimension_refresh(spark, w.src, root, p.refresh_as_of, p)
    q = queries()
    want = {k: q[f"refresh_{k}_dimension"](spark, SF_SMALL).count() for k in ("customer", "store", "product")}
    assert got == want and got["customer"] > 0 and got["product"] > 0
    st = jobs.Store(spark, root)
    for name in ("customer", "store", "product"):
        ds, dw = st.read_dim("ds", name), st.read_dim("dw", name)
        assert ds.count() == dw.count()
        flag = jobs.DIMENSIONS[name][1]
        assert ds.filter(~F.col(flag)).count() == 0
        key = jobs.DIMENSIONS[name][2]
        assert ds.select(key).distinct().count() == ds.count()


def test_late_refresh_reads_bucketed_index(spark, built):
    root, w, _ = built
    st = jobs.Store(spark, root)
    idx = spark.table(st.tid_index())
    assert idx.select("load_id").distinct().count() == 3
    plan = jobs.late_lines(st, w.src, "late-2")
    assert plan.count() == 0  # everything is loaded
    # when the index is too large to broadcast, its side of the anti join is
    # read bucket by bucket, without a shuffle
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        idx_only = w.src.salestransaction.join(st.loaded_tids("S"), "tid", "left_anti")
        text = idx_only._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "Bucketed: true" in text
    assert text.count("Exchange hashpartitioning") == 1


def test_rerun_heals_a_load_that_died_between_writes(spark):
    """DW written, then the job died before the DS write and the log: the
    rerun replaces the DW directory instead of adding to it."""
    from starloom.plans import loads
    root = tempfile.mkdtemp(prefix="starloom-wh3-")
    w = Warehouse(spark, SF_SMALL)
    p = w.p
    jobs.run_initial_load(spark, w.base_src, root, p.initial_as_of, p.dims_loaded_at, p)
    st = jobs.Store(spark, root)
    dims = st.dimensions("ds")
    partial = loads.daily_refresh(w.src, dims, st.read_fact("ds"), p.refresh_as_of, F.lit(st.mark()))
    st.write_fact("dw", "daily-1", partial.select(*S.FACT_DW_COLS), dims.calendar)   # the crash point
    r = jobs.run_daily_refresh(spark, w.src, root, p.refresh_as_of, "daily-1")
    assert r["rows"] == 370
    dw = st.read_fact("dw")
    assert dw.count() == 4022 + 370
    assert dw.select(*KEY).distinct().count() == dw.count()


def test_scd2_job_second_round_adds_nothing(spark):
    root = tempfile.mkdtemp(prefix="starloom-wh4-")
    w = Warehouse(spark, SF_SMALL)
    p = w.p
    jobs.run_initial_load(spark, w.base_src, root, p.initial_as_of, p.dims_loaded_at, p)
    first = jobs.run_scd2_products(spark, w.changed_src, root, p.scd_as_of, p)
    second = jobs.run_scd2_products(spark, w.changed_src, root, p.scd_as_of, p)
    assert first["new_versions"] == 44 and second == {"rows": 344, "new_versions": 0, "orphan_keys": 0}


# ---- hand-made rows: the order of jobs, crashes, and lines that come late ----
def _make(spark, **kw):
    root = tempfile.mkdtemp(prefix="starloom-wh5-")
    src = sd.make_sources(spark, **kw)
    jobs.run_initial_load(spark, src, root, sd.INITIAL_AS_OF, dt.datetime(2025, 1, 1))
    return root, jobs.Store(spark, root)


GROWN = {"salestransaction": sd.BASE_SALES + sd.NEW_SALES, "soldvia": sd.BASE_SOLD + sd.NEW_SOLD,
         "rentaltransaction": sd.BASE_RENTALS + sd.NEW_RENTALS, "rentvia": sd.BASE_RENTVIA + sd.NEW_RENTVIA}
LATE = {"salestransaction": GROWN["salestransaction"] + sd.LATE_SALES, "soldvia": GROWN["soldvia"] + sd.LATE_SOLD,
        "rentaltransaction": GROWN["rentaltransaction"] + sd.LATE_RENTALS, "rentvia": GROWN["rentvia"] + sd.LATE_RENTVIA}


def _edited(price="200.00"):
    return [(r[0], r[1], Dec(price) if r[0] == "1X2" else r[2], *r[3:]) for r in sd.PRODUCT]


def test_fact_jobs_after_a_type_2_round(spark):
    """One row a line, also for a product registered after the line's date."""
    root, st = _make(spark)
    product = _edited() + [("9X9", "Lamp", Dec("7.00"), "OA", "EL")]
    late = dict(LATE, product=product, salestransaction=LATE["salestransaction"] + [("OLDP", "6-7-888", "S4", dt.date(2025, 3, 1))],
                soldvia=LATE["soldvia"] + [("9X9", "OLDP", 1)])
    src, grown = sd.make_sources(spark, **late), sd.make_sources(spark, **dict(GROWN, product=product))
    jobs.run_dimension_refresh(spark, src, root, dt.datetime(2025, 3, 24, 2))
    assert jobs.run_scd2_products(spark, src, root, dt.datetime(2025, 3, 24, 2))["new_versions"] == 1
    daily = jobs.run_daily_refresh(spark, grown, root, sd.DAILY_AS_OF, "daily")
    assert daily["rows"] == 6 and daily["unresolved"] == 0
    late = jobs.run_late_fact_refresh(spark, src, root, sd.DAILY_AS_OF, "late")
    assert late["rows"] == 4
    dw = st.read_fact("dw")
    per_tid = {r.TID: r["sum(RevenueGenerated)"] for r in dw.groupBy("TID").sum("RevenueGenerated").collect()}
    assert (per_tid["ABC"], per_tid["CDE"], per_tid["OLDP"]) == (Dec("500.00"), Dec("690.00"), Dec("7.00"))
    assert dw.count() == 3 + 6 + 4 == dw.select(*S.FACT_KEY).distinct().count()


def test_calendar_grows_backwards(spark):
    """A late sale from the year before the calendar's first day is recovered."""
    root, st = _make(spark)
    before = {r.FullDate: r.Calendar_Key for r in st.read_dim("ds", "calendar").collect()}
    src = sd.make_sources(spark, salestransaction=sd.BASE_SALES + [("OLD", "6-7-888", "S4", dt.date(2024, 12, 31))],
                          soldvia=sd.BASE_SOLD + [("1X2", "OLD", 1)])
    assert jobs.run_late_fact_refresh(spark, src, root, sd.DAILY_AS_OF, "late")["rows"] == 1
    after = {r.FullDate: r.Calendar_Key for r in st.read_dim("dw", "calendar").collect()}
    assert before.items() <= after.items() and after[dt.date(2024, 12, 31)] == 0
    assert len(set(after.values())) == len(after) == 365 + 366
    assert st.read_fact("dw").filter("TID = 'OLD'").first().Calendar_Key == 0


def test_second_line_of_a_future_dated_transaction(spark):
    """Loaded ahead of the mark with one line; its other line comes later."""
    ahead = [("FUT", "6-7-888", "S4", dt.date(2025, 3, 25))]
    root, st = _make(spark, salestransaction=sd.BASE_SALES + ahead, soldvia=sd.BASE_SOLD + [("1X2", "FUT", 1)])
    src = sd.make_sources(spark, salestransaction=sd.BASE_SALES + ahead, soldvia=sd.BASE_SOLD + [("1X2", "FUT", 1), ("2X4", "FUT", 3)])
    assert jobs.run_daily_refresh(spark, src, root, sd.DAILY_AS_OF, "daily")["rows"] == 1
    lines = st.read_fact("dw").filter("TID = 'FUT'").collect()
    assert sorted(r.RevenueGenerated for r in lines) == [Dec("60.00"), Dec("100.00")]


def test_lines_without_keys_are_kept_and_tried_again(spark):
    root, st = _make(spark)
    product = sd.PRODUCT + [("9X9", "Lamp", Dec("7.00"), "OA", "EL")]
    src = sd.make_sources(spark, product=product, **dict(GROWN, soldvia=GROWN["soldvia"] + [("9X9", "ABC", 2)]))
    first = jobs.run_daily_refresh(spark, src, root, sd.DAILY_AS_OF, "daily")
    assert (first["rows"], first["unresolved"]) == (6, 1)
    left = st.read_unresolved("daily").collect()
    assert [(r.TID, r.ProductId, r.Reason) for r in left] == [("ABC", "9X9", "product")]
    again = jobs.run_daily_refresh(spark, src, root, sd.DAILY_AS_OF, "daily")
    assert (again["rows"], again["unresolved"]) == (6, 1)
    jobs.run_dimension_refresh(spark, src, root, sd.DAILY_AS_OF)
    second = jobs.run_late_fact_refresh(spark, src, root, sd.DAILY_AS_OF, "late")
    assert (second["rows"], second["unresolved"]) == (1, 0)
    assert jobs.run_late_fact_refresh(spark, src, root, sd.DAILY_AS_OF, "late-2")["rows"] == 0
    assert st.read_fact("dw").filter("TID = 'ABC'").count() == 3


def test_an_empty_load_leaves_the_warehouse_readable(spark):
    root, st = _make(spark, salestransaction=[], soldvia=[], rentaltransaction=sd.BASE_RENTALS, rentvia=[])
    assert st.read_fact("ds").count() == 0
    src = sd.make_sources(spark)
    assert jobs.run_late_fact_refresh(spark, src, root, sd.DAILY_AS_OF, "late")["rows"] == 3
    assert jobs.run_late_fact_refresh(spark, src, root, sd.DAILY_AS_OF, "late-2")["rows"] == 0
    assert jobs.run_daily_refresh(spark, src, root, sd.DAILY_AS_OF, "daily")["rows"] == 0
    assert st.read_fact("dw").count() == 3


def _files(root, pattern):
    """Files and the times of their last change."""
    import glob
    import os
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{root}/{pattern}", recursive=True)}


WRITES = {"fact": ["write_fact", "write_tid_index", "write_unresolved", "write_log"], "dim": ["write_dim"]}


class Crash(Exception):
    pass


def _crash_after(monkeypatch, method: str, nth: int):
    """The nth call of a write of the store succeeds, then the job dies."""
    original, calls = getattr(jobs.Store, method), []

    def write(self, *args, **kw):
        out = original(self, *args, **kw)
        calls.append(1)
        if len(calls) == nth:
            raise Crash
        return out

    monkeypatch.setattr(jobs.Store, method, write)


@pytest.mark.parametrize("method,nth", [("write_fact", 1), ("write_fact", 2), ("write_tid_index", 1), ("write_unresolved", 1), ("write_log", 1)])
def test_daily_load_dies_after_each_write(spark, monkeypatch, method, nth):
    root, st = _make(spark)
    src = sd.make_sources(spark, **GROWN)
    with monkeypatch.context() as m:
        _crash_after(m, method, nth)
        with pytest.raises(Crash):
            jobs.run_daily_refresh(spark, src, root, sd.DAILY_AS_OF, "daily")
    if method != "write_log":  # nothing else may start before the load is finished
        with pytest.raises(RuntimeError, match="unfinished"):
            jobs.run_late_fact_refresh(spark, src, root, sd.DAILY_AS_OF, "late")
    assert jobs.run_daily_refresh(spark, src, root, sd.DAILY_AS_OF, "daily")["rows"] == 6
    assert jobs.run_late_fact_refresh(spark, src, root, sd.DAILY_AS_OF, "late")["rows"] == 0
    assert st.read_fact("dw").count() == st.read_fact("ds").count() == 9


@pytest.mark.parametrize("nth", [1, 2, 3, 4])
def test_dimension_refresh_dies_after_each_write(spark, monkeypatch, nth):  # two dimensions, two layers
    root, st = _make(spark)
    src = sd.make_sources(spark, customer=sd.CUSTOMER + [("5-5-555", "Eve", "13000")], product=sd.PRODUCT + [("9X9", "Lamp", Dec("7.00"), "OA", "EL")])
    grown = sd.make_sources(spark, customer=[("0-0-000", "Abe", "13000"), *sd.CUSTOMER, ("5-5-555", "Eve", "13000")],
                            product=sd.PRODUCT + [("9X9", "Lamp", Dec("7.00"), "OA", "EL")])
    with monkeypatch.context() as m:
        _crash_after(m, "append_dim", nth)
        with pytest.raises(Crash):
            jobs.run_dimension_refresh(spark, src, root, sd.DAILY_AS_OF)
    jobs.run_dimension_refresh(spark, grown, root, sd.DAILY_AS_OF)  # the source has grown in between
    for name, n in (("customer", 6), ("product", 10)):
        key = jobs.DIMENSIONS[name][2]
        ds, dw = (sorted(map(tuple, st.read_dim(layer, name).select(*jobs.DIMENSIONS[name][3]).collect()), key=str) for layer in ("ds", "dw"))
        assert ds == dw and len(ds) == n == len({r[0] for r in ds})


@pytest.mark.parametrize("nth", [1, 2])
def test_type_2_job_dies_after_each_write(spark, monkeypatch, nth):
    root, st = _make(spark)
    at = dt.datetime(2025, 3, 24, 2)
    with monkeypatch.context() as m:
        _crash_after(m, "write_dim", nth)
        with pytest.raises(Crash):
            jobs.run_scd2_products(spark, sd.make_sources(spark, product=_edited()), root, at)
    jobs.run_scd2_products(spark, sd.make_sources(spark, product=_edited()), root, at)
    ds, dw = (sorted(map(tuple, st.read_dim(layer, "product").select(*S.PRODUCT_DW_COLS, *S.SCD_COLS).collect()), key=str) for layer in ("ds", "dw"))
    assert ds == dw and len(ds) == 10


def test_unchanged_dimensions_are_not_rewritten(spark):
    root, st = _make(spark)
    before = _files(root, "*/*/*/*.parquet")
    jobs.run_dimension_refresh(spark, sd.make_sources(spark), root, sd.DAILY_AS_OF)
    jobs.run_scd2_products(spark, sd.make_sources(spark), root, sd.DAILY_AS_OF)
    assert before == _files(root, "*/*/*/*.parquet") and not st.has_later_snapshots()


def test_new_members_are_written_as_parts(spark):
    """One new customer: one file more in each layer, no other one touched."""
    root, st = _make(spark)
    before = _files(root, "d?/customer/**/*.parquet")
    src = sd.make_sources(spark, customer=sd.CUSTOMER + [("5-5-555", "Eve", "13000")])
    assert jobs.run_dimension_refresh(spark, src, root, sd.DAILY_AS_OF)["customer"] == 1
    after = _files(root, "d?/customer/**/*.parquet")
    assert before.items() <= after.items() and len(after) == len(before) + 2
    assert st.read_dim("dw", "customer").count() == st.read_dim("ds", "customer").count() == 5


def test_fact_and_index_files_are_gathered(spark, built):
    """A month of a load is one file here, an index bucket at most one a load."""
    import glob
    root = built[0]
    for d in glob.glob(f"{root}/dw/revenue_fact/load_id=*/fact_year=*/fact_month=*"):
        assert len(glob.glob(f"{d}/*.parquet")) == 1
    for d in glob.glob(f"{root}/ds/loaded_tids-*/load_id=*"):
        assert len(glob.glob(f"{d}/*.parquet")) <= jobs.DEFAULT.tid_buckets


# ---- the initial load again, half-written loads, blocks of keys -----------------
def test_initial_load_again_before_anything_else(spark):
    root, st = _make(spark)
    grown = sd.make_sources(spark, product=[("0X0", "Axe", Dec("9.00"), "OA", "EL"), *sd.PRODUCT])
    jobs.run_initial_load(spark, grown, root, sd.INITIAL_AS_OF, dt.datetime(2025, 1, 1))
    dw = st.read_fact("dw").join(st.read_dim("dw", "product"), "Product_Key")
    assert st.latest_snapshot("dw", "product") == 0 and st.read_dim("dw", "product").count() == 10
    assert sorted((r.TID, r.ProductId) for r in dw.collect()) == [("R1", "1X1"), ("T1", "1X2"), ("T2", "2X4")]


@pytest.mark.parametrize("change", ["type 2", "refresh", "daily"])
def test_initial_load_is_refused_once_the_warehouse_has_changed(spark, change):
    root, st = _make(spark)
    src = sd.make_sources(spark, **dict(GROWN, product=_edited() + [("9X9", "Lamp", Dec("7.00"), "OA", "EL")]))
    if change == "type 2":
        jobs.run_scd2_products(spark, src, root, dt.datetime(2025, 3, 24, 2))
    elif change == "refresh":
        jobs.run_dimension_refresh(spark, src, root, dt.datetime(2025, 3, 24, 2))
    jobs.run_daily_refresh(spark, src, root, sd.DAILY_AS_OF, "daily") if change != "refresh" else None
    before = _files(root, "**/*.parquet")
    with pytest.raises(RuntimeError, match="not the latest|changed since"):
        jobs.run_initial_load(spark, src, root, sd.INITIAL_AS_OF, dt.datetime(2025, 1, 1))
    assert before == _files(root, "**/*.parquet")


def test_a_log_directory_without_rows_is_no_finished_load(spark, monkeypatch):
    """The job died while writing the log: the load is unfinished for all."""
    import os
    root, st = _make(spark)
    src = sd.make_sources(spark, **GROWN)
    with monkeypatch.context() as m:
        _crash_after(m, "write_unresolved", 1)
        with pytest.raises(Crash):
            jobs.run_daily_refresh(spark, src, root, sd.DAILY_AS_OF, "daily")
    os.makedirs(f"{root}/_loads/load_id=daily")
    assert st.load_ids() == ["initial"]
    assert st.read_fact("dw").count() == st.read_fact("ds").count() == 3  # not seen by marts
    with pytest.raises(RuntimeError, match="unfinished"):
        jobs.run_late_fact_refresh(spark, src, root, sd.DAILY_AS_OF, "late")
    assert jobs.run_daily_refresh(spark, src, root, sd.DAILY_AS_OF, "daily")["rows"] == 6
    assert st.read_fact("dw").count() == 9


def test_blocks_of_keys_are_disjoint_and_a_rerun_keeps_its_own(spark):
    from concurrent.futures import ThreadPoolExecutor
    root, st = _make(spark)
    assert st.reserve_keys("customer", 5, 4, "a") == 5
    assert st.reserve_keys("customer", 3, 4, "b") == 10
    assert st.reserve_keys("customer", 5, 4, "a") == 5
    assert st.reserve_keys("customer", 2, 40, "c") == 41
    with ThreadPoolExecutor(4) as pool:
        starts = [*pool.map(lambda k: jobs.Store(spark, root).reserve_keys("store", 10, 3, f"job {k}"), range(4))]
    assert sorted(starts) == [4, 14, 24, 34]


def test_two_refreshes_of_one_dimension_do_not_clash(spark):
    """Both have read the dimension before the other has written to it."""
    root, st = _make(spark)
    cur = st.read_dim("ds", "customer")
    members = {"a": [("5-5-555", "Eve", "13000"), ("5-5-556", "Fay", "13000")], "b": [("6-6-666", "Gus", "13000")]}
    for job, rows in members.items():
        src = sd.make_sources(spark, customer=sd.CUSTOMER + rows)
        new = jobs.D.refresh_customer_dimension(src, cur, sd.DAILY_AS_OF).select(*cur.columns).checkpoint()
        st.append_dim("ds", "customer", jobs._in_own_block(st, "customer", new, job))
    keys = {r.CustomerID: r.Customer_Key for r in st.read_dim("ds", "customer").collect()}
    assert len(keys) == len({*keys.values()}) == 7 and {keys["5-5-555"], keys["5-5-556"]} == {5, 6} and keys["6-6-666"] == 7


def test_type_2_round_of_customers_and_stores(spark):
    root, st = _make(spark)
    src = sd.make_sources(spark, **dict(GROWN, customer=[("6-7-888", "Ann", "99999"), *sd.CUSTOMER[1:]], store=[("S4", "99999", "C"), *sd.STORE[1:]]))
    at = dt.datetime(2025, 3, 26, 2)
    assert jobs.run_scd2_members(spark, src, root, "customer", at) == {"rows": 5, "new_versions": 1, "orphan_keys": 0}
    assert jobs.run_scd2_members(spark, src, root, "store", at) == {"rows": 4, "new_versions": 1, "orphan_keys": 0}
    assert jobs.run_scd2_members(spark, src, root, "store", at)["new_versions"] == 0
    assert jobs.run_daily_refresh(spark, src, root, sd.DAILY_AS_OF, "daily")["rows"] == 6
    zips = (st.read_fact("dw").join(st.read_dim("dw", "customer"), "Customer_Key").join(st.read_dim("dw", "store"), "Store_Key")
            .select("TID", "CustomerZip", "StoreZip").distinct().collect())
    by_tid = {r.TID: (r.CustomerZip, r.StoreZip) for r in zips}
    assert by_tid["T1"] == ("13699", "13676") and by_tid["CDE"] == ("99999", "99999")  # before and after the change


# ---- the snapshot kept up load by load -------------------------------------------
def _whole(spark, st):
    return sorted(map(tuple, jobs.M.daily_store_snapshot(st.read_fact("dw"), st.dimensions("dw")).collect()))


def test_snapshot_follows_the_loads_and_leaves_other_months_alone(spark):
    root, st = _make(spark, salestransaction=sd.BASE_SALES + [("JAN", "6-7-888", "S4", dt.date(2025, 1, 9))],
                     soldvia=sd.BASE_SOLD + [("1X2", "JAN", 1)])
    grown = dict(GROWN, salestransaction=GROWN["salestransaction"] + [("JAN", "6-7-888", "S4", dt.date(2025, 1, 9))],
                 soldvia=GROWN["soldvia"] + [("1X2", "JAN", 1), ("9X9", "ABC", 2)],
                 product=sd.PRODUCT + [("9X9", "Lamp", Dec("700.00"), "OA", "EL")])
    assert sorted(map(tuple, jobs.run_daily_store_snapshot(spark, root).collect())) == _whole(spark, st)
    january = _files(root, "marts/daily_store_snapshot/fact_year=2025/fact_month=1/*.parquet")
    assert january
    src = sd.make_sources(spark, **grown)
    assert jobs.run_daily_refresh(spark, src, root, sd.DAILY_AS_OF, "daily")["unresolved"] == 1
    assert sorted(map(tuple, jobs.run_daily_store_snapshot(spark, root).collect())) == _whole(spark, st)
    # the rest of a transaction counted before: more lines, no more transactions
    jobs.run_dimension_refresh(spark, src, root, sd.DAILY_AS_OF)
    assert jobs.run_late_fact_refresh(spark, src, root, sd.DAILY_AS_OF, "late")["rows"] == 1
    snap = jobs.run_daily_store_snapshot(spark, root)
    assert sorted(map(tuple, snap.collect())) == _whole(spark, st)
    assert january == _files(root, "marts/daily_store_snapshot/fact_year=2025/fact_month=1/*.parquet")
    before = _files(root, "marts/**/*.parquet")
    jobs.run_daily_store_snapshot(spark, root)  # nothing new
    assert before == _files(root, "marts/**/*.parquet")


def test_snapshot_after_a_load_that_is_run_again(spark):
    """The second run of the load has one transaction less, and another day."""
    root, st = _make(spark)
    jobs.run_daily_refresh(spark, sd.make_sources(spark, **GROWN), root, sd.DAILY_AS_OF, "daily")
    jobs.run_daily_store_snapshot(spark, root)
    moved = dict(GROWN, salestransaction=sd.BASE_SALES + [("ABC", "1-2-333", "S10", dt.date(2025, 4, 2))], rentaltransaction=sd.BASE_RENTALS)
    jobs.run_daily_refresh(spark, sd.make_sources(spark, **moved), root, sd.DAILY_AS_OF, "daily")
    assert sorted(map(tuple, jobs.run_daily_store_snapshot(spark, root).collect())) == _whole(spark, st)
    other = jobs.Params(tracked_category="Cycling", high_value=50)
    assert (sorted(map(tuple, jobs.run_daily_store_snapshot(spark, root, other).collect()))
            == sorted(map(tuple, jobs.M.daily_store_snapshot(st.read_fact("dw"), st.dimensions("dw"), other).collect())))


def test_snapshot_job_dies_before_it_is_noted(spark, monkeypatch):
    root, st = _make(spark)
    jobs.run_daily_store_snapshot(spark, root)
    jobs.run_daily_refresh(spark, sd.make_sources(spark, **GROWN), root, sd.DAILY_AS_OF, "daily")
    with monkeypatch.context() as m:
        m.setattr(jobs.M, "merge_states", lambda states: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            jobs.run_daily_store_snapshot(spark, root)
    assert sorted(map(tuple, jobs.run_daily_store_snapshot(spark, root).collect())) == _whole(spark, st)


# ---- large dimensions, the index of loaded transactions, audits of one load --------
def test_loads_with_carried_dimensions_equal_the_others(spark, monkeypatch):
    import dataclasses
    results = []
    for above in (2_000_000, 0):
        monkeypatch.setattr(jobs, "DEFAULT", dataclasses.replace(jobs.DEFAULT, carry_above=above))
        root, st = _make(spark)
        src = sd.make_sources(spark, **dict(LATE, product=_edited()))
        jobs.run_scd2_products(spark, src, root, dt.datetime(2025, 3, 24, 2))
        jobs.run_daily_refresh(spark, src, root, sd.DAILY_AS_OF, "daily")
        jobs.run_late_fact_refresh(spark, src, root, sd.DAILY_AS_OF, "late")
        results.append(sorted(map(tuple, st.read_fact("dw").collect())))
    assert results[0] == results[1] and len(results[0]) == 12


def test_index_of_loaded_transactions_is_pruned_and_grows(spark):
    root, st = _make(spark)
    src = sd.make_sources(spark, **GROWN)
    jobs.run_daily_refresh(spark, src, root, sd.DAILY_AS_OF, "daily")
    tids = lambda **kw: sorted(r[0] for r in st.loaded_tids("S", **kw).collect())
    assert tids() == ["ABC", "CDE", "T1", "T2"]
    assert tids(within=("T0", "T9")) == ["T1", "T2"] and tids(within=("A", "B")) == ["ABC", "CDE"] and tids(within=("X", "Y")) == []
    files = st.loaded_tids("S", within=("T0", "T9")).inputFiles()
    assert files and all("load_id=initial" in f for f in files)
    st.grow_tid_index(128)
    fresh = jobs.Store(spark, root)
    assert fresh._children(f"{root}/ds", "loaded_tids-") == ["128"] and fresh._children(f"{root}/ds", "growing_tids-") == []
    assert tids() == sorted(r[0] for r in fresh.loaded_tids("S").collect()) == ["ABC", "CDE", "T1", "T2"]
    assert jobs.run_late_fact_refresh(spark, sd.make_sources(spark, **LATE), root, sd.DAILY_AS_OF, "late")["rows"] == 3
    assert len(tids()) == 5


def test_audit_of_one_load_reads_no_other(spark):
    root, st = _make(spark)
    jobs.run_daily_refresh(spark, sd.make_sources(spark, **GROWN), root, sd.DAILY_AS_OF, "daily")
    clean = {"Customer_Dimension": 0, "Store_Dimension": 0, "Product_Dimension": 0, "Calendar_Dimension": 0}
    assert jobs.run_load_audit(spark, root, "daily") == clean
    plan = st.read_fact("dw", only=["daily"])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*load_id#\d+ = daily", plan)
    planted = st.read_fact("dw", only=["daily"], keep_partitions=True).withColumn("Store_Key", F.col("Store_Key") + 70_000).checkpoint()
    st.write_fact("dw", "daily", planted)
    assert jobs.run_load_audit(spark, root, "daily") == {**clean, "Store_Dimension": 6}
    assert jobs.run_load_audit(spark, root, "initial") == clean
