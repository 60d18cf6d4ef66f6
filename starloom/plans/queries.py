"""The query registry: one entry per operator of the warehouse.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame computed
from the whole fixture tables.  Column names equal those of the SQL oracle
in :mod:`starloom.plans.oracle`."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..config import DEFAULT, Params
from ..operators import audit as A
from ..operators import dims as D
from ..operators import facts as FX
from ..operators import load as L
from ..operators import lookup
from ..operators import marts as M
from ..operators import scd2
from ..operators.keys import assign_surrogate_keys
from . import loads
from .scenario import Warehouse

Query = Callable[[SparkSession, str], DataFrame]


def _q(fn: Callable[[Warehouse], DataFrame], params: Params = DEFAULT) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Warehouse(spark, sf_dir, params))
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


# ---- sources and dimensions ------------------------------------------------
def scan_sources(w: Warehouse) -> DataFrame:
    """Rows of each operational table (A1)."""
    parts = [df.agg(F.count(F.lit(1)).cast("long").alias("NumRows")).select(F.lit(n).alias("TableName"), "NumRows")
             for n, df in w.src.tables().items()]
    return reduce(DataFrame.unionByName, parts)


def customer_dimension(w):
    return w.dims.customer


def store_dimension(w):
    return w.dims.store


def product_dimension(w):
    return w.dims.product


def calendar_dimension(w):
    return w.dims.calendar


def assign_keys(w):
    """Surrogate keys in natural-key order, distributed."""
    rows = D.customer_rows(w.src).select("CustomerID")
    return assign_surrogate_keys(rows, D.CUSTOMER_ORDER, "Customer_Key")


def backfill_load_columns(w):
    """Dimension with the load columns added and back-filled."""
    return L.backfill(w.dims.customer, {"ExtractionTimestamp": w.p.dims_loaded_at, "Cloaded": True})


def product_cat_dimension(w):
    return D.product_cat_dimension(w.dims.product)


# ---- fact extraction and loads -------------------------------------------------
def calendar_extension(w):
    """A calendar of some middle years grown in both directions."""
    s, p = w.src, w.p
    within = F.col("tdate").between(p.calendar_first, p.calendar_last)
    some = s.replace(salestransaction=s.salestransaction.filter(within), rentaltransaction=s.rentaltransaction.filter(within))
    return D.extend_calendar(s, D.calendar_dimension(some))


def extraction_high_water_mark(w):
    return FX.high_water_mark(w.full_initial_fact)


def extract_sales(w):
    return FX.extract_sales(w.src, FX.after_mark(w.src.salestransaction, w.mark))


def extract_rentals_daily(w):
    return FX.extract_rentals_daily(w.src, FX.after_mark(w.src.rentaltransaction, w.mark))


def extract_rentals_weekly(w):
    return FX.extract_rentals_weekly(w.src, FX.after_mark(w.src.rentaltransaction, w.mark))


def intermediate_fact(w):
    return w.daily_inter


def initial_fact_load(w):
    """Every transaction line of the whole tables."""
    return w.full_initial_fact


def daily_refresh_facts(w):
    """Rows the daily refresh appends to the staging fact, after publishing."""
    return L.mark_loaded(w.daily_new, "f_loaded")


def publish_unloaded_facts(w):
    """Rows the daily refresh publishes to the warehouse fact."""
    return L.publish_unloaded(w.initial_fact.unionByName(w.daily_new), "f_loaded", S.FACT_DW_COLS)


def late_facts(w):
    return w.late_inter


def late_fact_refresh(w):
    return L.mark_loaded(w.late_new, "f_loaded")


def resolve_fact_keys(w):
    """Literal lookup against the dimension after a Type 2 round: a line
    meets every version of its product (the original behaviour)."""
    return FX.resolve_fact_keys(FX.intermediate_fact(w.src), w.dims_after_scd(), w.p.refresh_as_of,
                                as_of_lookup=False)


def resolve_fact_keys_asof(w):
    """Lookup of the product version valid on the transaction date."""
    return FX.resolve_fact_keys(FX.intermediate_fact(w.src), w.dims_after_scd(), w.p.refresh_as_of)


def resolve_fact_keys_carried(w):
    """The same lookup with the product versions carried forward to the lines,
    frequent products apart.  The lines are extracted once, for the sketch of
    their products and for the lookup."""
    inter = w.table(FX.intermediate_fact(w.src))
    return FX.resolve_fact_keys(inter, w.dims_after_scd(), w.p.refresh_as_of, carried=("product",),
                                hot={"product": lookup.hot_members(inter, "ProductId")})


def resolve_fact_keys_split(w):
    """Key lookup of lines of which every second transaction is one customer's:
    frequent customers and stores are looked up apart."""
    inter = w.stored(w.hot_customer_lines())
    hot = {"customer": lookup.hot_members(inter, "CustomerId"), "store": lookup.hot_members(inter, "StoreId")}
    return FX.resolve_fact_keys(inter, w.dims, w.p.refresh_as_of, hot=hot)


def daily_refresh_after_scd2(w):
    """The daily refresh with a product dimension that has a history."""
    return L.mark_loaded(loads.daily_refresh(w.src, w.dims_after_scd(), w.initial_fact, w.p.refresh_as_of, w.mark), "f_loaded")


def late_refresh_after_scd2(w):
    """The late-fact refresh with a product dimension that has a history."""
    return L.mark_loaded(loads.late_fact_refresh(w.src, w.dims_after_scd(), w.after_daily, w.p.refresh_as_of), "f_loaded")


def unresolved_facts(w):
    """New lines whose customer, store or product the dimensions loaded before
    the refresh lack (what a fact refresh drops if run before the dimension
    refreshes)."""
    dims = FX.Dimensions(customer=w.prior_dim("customer"), store=w.prior_dim("store"),
                         product=w.prior_dim("product"), calendar=w.dims.calendar)
    return FX.unresolved_facts(w.daily_inter, dims)


# ---- marts ---------------------------------------------------------------
def daily_store_snapshot_base(w):
    return M.daily_store_snapshot_base(w.fact)


def daily_store_snapshot(w):
    return M.daily_store_snapshot(w.fact, w.dims, w.p)


def daily_store_snapshot_incremental(w):
    """The snapshot kept up over three loads: a state, and what two later loads
    add to it.  The loads split transactions (each has the lines of every third
    product), so most of their transactions were counted before."""
    part = [w.published_fact.filter(F.col("Product_Key") % 3 == k) for k in range(3)]
    states = M.snapshot_state(part[0], w.dims, w.p).unionByName(M.snapshot_delta(part[1], part[0], w.dims, w.p))
    states = states.unionByName(M.snapshot_delta(part[2], part[0].unionByName(part[1]), w.dims, w.p))
    return M.snapshot_of_state(M.merge_states(states))


def daily_store_snapshot_update_joins(w):
    return M.daily_store_snapshot_update_joins(w.published_fact, w.dims, w.p)


def footwear_revenue(w):
    return M.footwear_revenue(w.fact, w.dims.product, w.p.tracked_category)


def hv_transactions(w):
    return M.hv_transactions(w.fact, w.p.high_value)


def local_revenue(w):
    return M.local_revenue(w.fact, w.dims, w.p.zip_prefix)


def one_way_revenue_by_category(w):
    return M.one_way_revenue_by_category(w.fact, w.dims.product, D.product_cat_dimension(w.dims.product))


def revenue_by_month_region(w):
    return M.revenue_by_month_region(w.fact, w.dims)


def revenue_by_product_type(w):
    return M.revenue_by_product_type(w.fact, w.dims.product)


def revenue_rollups(w):
    """All levels of year, month, region and category."""
    return M.revenue_rollups(w.published_fact, w.dims)


def revenue_by_customer(w):
    return M.revenue_by_customer(w.fact, w.dims.customer)


def revenue_by_store(w):
    return M.revenue_by_store(w.fact, w.dims.store)


# ---- Type 2 ----------------------------------------------------------------
def scd2_initialise(w):
    return w.product_ds


def scd2_changed_products(w):
    return w.changed_products


def scd2_changed_products_by_digest(w):
    """The same changes, found by comparing digests of ranges first."""
    return scd2.detect_product_changes_by_digest(w.changed_src, w.product_ds)


def scd2_expired_rows(w):
    return scd2.expired_rows(w.product_ds, w.changed_products, w.p.scd_as_of)


def scd2_new_versions(w):
    return scd2.new_versions(w.changed_src, w.changed_products, w.product_ds, w.p.scd_as_of, w.p.open_dvu)


def scd2_product_dimension(w):
    """Staging product dimension at the end of the Type 2 procedure
    (detect, expire, insert, publish, then flag everything loaded)."""
    return L.mark_loaded(w.product_after_scd, "PDloaded")


def upsert_product_dimension(w):
    """Warehouse product dimension after ``REPLACE INTO`` from a staging table
    that lacks some of its products (A15)."""
    cols = S.PRODUCT_DW_COLS + S.SCD_COLS
    staged = w.product_after_scd.select(*cols).filter(F.substring("ProductId", 2, 20).cast("long") % 50 != w.p.dw_only_remainder)
    return L.upsert(w.product_ds.select(*cols), staged, ["Product_Key"])


_SALES_PRICES = [("productprice", "ProductSalesPrice")]
_RENTAL_PRICES = [("productpricedaily", "ProductDailyRentalPrice"), ("productpriceweekly", "ProductWeeklyRental")]


def price_comparison(w):
    """Sales products whose source price differs from the current row."""
    return scd2.price_comparison(D.product_sales_rows(w.changed_src), w.product_ds, S.PRODUCT_SALES, _SALES_PRICES, changed_only=True)


def price_comparison_sales(w):
    """Source and current price of every sales product."""
    return scd2.price_comparison(D.product_sales_rows(w.changed_src), w.product_ds, S.PRODUCT_SALES, _SALES_PRICES)


def price_comparison_rentals(w):
    """Source and current prices of every rental product."""
    return scd2.price_comparison(D.product_rental_rows(w.changed_src), w.product_ds, S.PRODUCT_RENTAL, _RENTAL_PRICES)


# ---- dimension refresh ---------------------------------------------------------
def refresh_product_dimension(w):
    return L.mark_loaded(D.refresh_product_dimension(w.src, w.prior_dim("product"), w.p.refresh_as_of,
                                                     w.p.open_dvu), "PDloaded")


def refresh_store_dimension(w):
    return L.mark_loaded(D.refresh_store_dimension(w.src, w.prior_dim("store"), w.p.refresh_as_of,
                                                   w.p.open_dvu), "Sloaded")


def refresh_customer_dimension(w):
    return L.mark_loaded(D.refresh_customer_dimension(w.src, w.prior_dim("customer"), w.p.refresh_as_of,
                                                      w.p.customer_stamp_lag_days, w.p.open_dvu), "Cloaded")


# ---- audits ----------------------------------------------------------------
def audit_fact_pk(w):
    """Primary-key audit of the fact after all loads, with planted duplicates."""
    return A.primary_key_audit(w.planted_fact(), S.FACT_KEY)


def audit_fact_orphans(w):
    """Foreign-key audit of that fact against dimensions that lack some keys."""
    return A.orphan_audit(w.planted_fact(), w.short_dims())


def audit_load_orphans(w):
    """Foreign-key audit of the daily load only, by key bitmaps."""
    return A.load_orphan_audit(w.daily_new, w.short_dims())


def audit_nulls(w):
    return A.null_audit({"RevenueFact": w.fact.select(*S.FACT_DW_COLS),
                         "Customer_Dimension": w.dims.customer, "Store_Dimension": w.dims.store,
                         "Product_Dimension": w.dims.product, "Calendar_Dimension": w.dims.calendar})


def audit_lengths(w):
    return A.length_audit({"RevenueFact": w.fact, "Customer_Dimension": w.dims.customer,
                           "Store_Dimension": w.dims.store, "Product_Dimension": w.dims.product},
                          S.LENGTH_LIMITS)


_ALL = [
    scan_sources, customer_dimension, store_dimension, product_dimension, calendar_dimension, calendar_extension,
    backfill_load_columns, product_cat_dimension,
    extraction_high_water_mark, extract_sales, extract_rentals_daily, extract_rentals_weekly,
    intermediate_fact, initial_fact_load, daily_refresh_facts, publish_unloaded_facts, late_facts,
    late_fact_refresh, resolve_fact_keys, resolve_fact_keys_asof, resolve_fact_keys_carried,
    resolve_fact_keys_split, unresolved_facts,
    daily_refresh_after_scd2, late_refresh_after_scd2,
    daily_store_snapshot_base, daily_store_snapshot, daily_store_snapshot_incremental, daily_store_snapshot_update_joins, footwear_revenue, hv_transactions, local_revenue,
    one_way_revenue_by_category, revenue_by_month_region, revenue_by_product_type,
    revenue_rollups, revenue_by_customer, revenue_by_store,
    scd2_initialise, scd2_changed_products, scd2_changed_products_by_digest, scd2_expired_rows, scd2_new_versions, scd2_product_dimension,
    upsert_product_dimension, price_comparison, price_comparison_sales, price_comparison_rentals,
    refresh_product_dimension, refresh_store_dimension, refresh_customer_dimension,
    audit_fact_pk, audit_fact_orphans, audit_load_orphans, audit_nulls, audit_lengths,
]


def queries(params: Params = DEFAULT) -> dict[str, Query]:
    reg = {fn.__name__: _q(fn, params) for fn in _ALL}
    reg["assign_surrogate_keys"] = _q(assign_keys, params)
    return reg
