"""Dimension builds (full and incremental) from the operational tables."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.clock import ts
from ..sources import Sources
from .keys import assign_surrogate_keys, max_key

# Natural keys and key order of each dimension.  Product rows of the sales
# list are numbered before rental rows, as the refresh inserts them first.
# Orders are (column, ascending) pairs, turned into sort columns on use.
CUSTOMER_ORDER = [("CustomerID", True)]
STORE_ORDER = [("StoreID", True)]
PRODUCT_ORDER = [("ProductType", False), ("ProductId", True)]
CATEGORY_ORDER = [("CategoryID", True), ("Categoryname", True)]
PRODUCT_NK = ["ProductId", "ProductType"]


def customer_rows(src: Sources) -> DataFrame:
    return src.customer.select(F.col("customerid").alias("CustomerID"),
                               F.col("customername").alias("CustomerName"),
                               F.col("customerzip").alias("CustomerZip"))


def store_rows(src: Sources) -> DataFrame:
    """store ⋈ region; a store whose region is unknown is left out."""
    return (src.store.join(src.region, "regionid")
            .select(F.col("storeid").alias("StoreID"), F.col("storezip").alias("StoreZip"),
                    F.col("regionid").alias("RegionID"), F.col("regionname").alias("RegionName")))


def _with_names(df: DataFrame, src: Sources) -> DataFrame:
    return df.join(src.category, "categoryid").join(src.vendor, "vendorid")


def product_sales_rows(src: Sources) -> DataFrame:
    """Sales price list ⋈ category ⋈ vendor, typed ``Sales``."""
    null_price = F.lit(None).cast(S.PRICE)
    return (_with_names(src.product, src)
            .select(F.col("productid").alias("ProductId"), F.col("productname").alias("Productname"),
                    F.col("vendorid").alias("VendorId"), F.col("vendorname").alias("Vendorname"),
                    F.col("categoryid").alias("CategoryID"), F.col("categoryname").alias("Categoryname"),
                    F.col("productprice").alias("ProductSalesPrice"),
                    null_price.alias("ProductDailyRentalPrice"), null_price.alias("ProductWeeklyRental"),
                    F.lit(S.PRODUCT_SALES).alias("ProductType")))


def product_rental_rows(src: Sources) -> DataFrame:
    """Rental price list ⋈ category ⋈ vendor, typed ``Rental``."""
    return (_with_names(src.rentalproducts, src)
            .select(F.col("productid").alias("ProductId"), F.col("productname").alias("Productname"),
                    F.col("vendorid").alias("VendorId"), F.col("vendorname").alias("Vendorname"),
                    F.col("categoryid").alias("CategoryID"), F.col("categoryname").alias("Categoryname"),
                    F.lit(None).cast(S.PRICE).alias("ProductSalesPrice"),
                    F.col("productpricedaily").alias("ProductDailyRentalPrice"),
                    F.col("productpriceweekly").alias("ProductWeeklyRental"),
                    F.lit(S.PRODUCT_RENTAL).alias("ProductType")))


def product_rows(src: Sources) -> DataFrame:
    return product_sales_rows(src).unionByName(product_rental_rows(src))


def load_columns(df: DataFrame, flag_col: str, stamp: _dt.datetime, loaded: bool) -> DataFrame:
    """Staging columns: extraction stamp and the loaded flag."""
    return df.withColumn("ExtractionTimestamp", ts(stamp)).withColumn(flag_col, F.lit(loaded))


def scd_columns(df: DataFrame, dvf: _dt.date, dvu: _dt.date = S.OPEN_DVU,
                status: str = S.STATUS_CURRENT) -> DataFrame:
    """Type 2 history columns: valid-from, valid-until (inclusive), status."""
    return (df.withColumn("DVF", F.lit(dvf)).withColumn("DVU", F.lit(dvu))
            .withColumn("CurrentStatus", F.lit(status)))


def _keyed(rows: DataFrame, order, key_col: str, cols: list[str], base=0) -> DataFrame:
    return assign_surrogate_keys(rows, order, key_col, base).select(*cols, *[c for c in rows.columns
                                                                             if c not in cols])


def customer_dimension(src: Sources) -> DataFrame:
    return _keyed(customer_rows(src), CUSTOMER_ORDER, "Customer_Key", S.CUSTOMER_DW_COLS)


def store_dimension(src: Sources) -> DataFrame:
    return _keyed(store_rows(src), STORE_ORDER, "Store_Key", S.STORE_DW_COLS)


def product_dimension(src: Sources) -> DataFrame:
    return _keyed(product_rows(src), PRODUCT_ORDER, "Product_Key", S.PRODUCT_DW_COLS)


def calendar_dimension(src: Sources) -> DataFrame:
    """One row per day, from 1 January of the first transaction year to
    31 December of the last; the key is the day number, so it is dense and
    ordered like the date without a global sort."""
    dates = (src.salestransaction.select("tdate")
             .unionByName(src.rentaltransaction.select("tdate")))
    bounds = dates.agg(F.make_date(F.year(F.min("tdate")), F.lit(1), F.lit(1)).alias("lo"),
                       F.make_date(F.year(F.max("tdate")), F.lit(12), F.lit(31)).alias("hi"))
    days = bounds.select("lo", F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("FullDate"))
    return days.select((F.datediff("FullDate", "lo") + 1).cast("long").alias("Calendar_Key"),
                       "FullDate",
                       F.month("FullDate").alias("CalendarMonth"),
                       F.year("FullDate").alias("CalendarYear"))


def extend_calendar(src: Sources, calendar: DataFrame) -> DataFrame:
    """The calendar grown to cover every transaction year, in both directions
    (a late transaction may be older than the first day).

    Keys are day numbers counted from the day with key 1, so existing rows keep
    their keys, later days continue the sequence and earlier ones go on below 1."""
    dates = (src.salestransaction.select("tdate")
             .unionByName(src.rentaltransaction.select("tdate")))
    need = dates.agg(F.make_date(F.year(F.min("tdate")), F.lit(1), F.lit(1)).alias("lo"),
                     F.make_date(F.year(F.max("tdate")), F.lit(12), F.lit(31)).alias("hi"))
    have = calendar.agg(F.min("FullDate").alias("first"), F.max("FullDate").alias("last"),
                        F.min(F.date_sub("FullDate", (F.col("Calendar_Key") - 1).cast("int"))).alias("one"))
    # one row each: the bounds as scalar subqueries
    lo, hi = need.select("lo").scalar(), need.select("hi").scalar()
    before = have.filter(lo < F.col("first")).select("one", F.explode(F.sequence(lo, F.date_sub("first", 1), F.expr("INTERVAL 1 DAY"))).alias("FullDate"))
    after = have.filter(hi > F.col("last")).select("one", F.explode(F.sequence(F.date_add("last", 1), hi, F.expr("INTERVAL 1 DAY"))).alias("FullDate"))
    new = before.unionByName(after).select((F.datediff("FullDate", "one") + 1).cast("long").alias("Calendar_Key"), "FullDate",
                                           F.month("FullDate").alias("CalendarMonth"), F.year("FullDate").alias("CalendarYear"))
    return calendar.select(*S.CALENDAR_COLS).unionByName(new)


def product_cat_dimension(product_dim: DataFrame) -> DataFrame:
    """Distinct categories of the product dimension with their own key."""
    cats = product_dim.select("CategoryID", "Categoryname").distinct()
    return _keyed(cats, CATEGORY_ORDER, "Product_cat_Key",
                  ["Product_cat_Key", "CategoryID", "Categoryname"])


def refresh_dimension(rows: DataFrame, dim: DataFrame, natural_key: list[str], order, key_col: str,
                      cols: list[str], flag_col: str, stamp: _dt.datetime, as_of: _dt.datetime,
                      open_dvu: _dt.date = S.OPEN_DVU) -> DataFrame:
    """Rows of the source whose natural key the dimension lacks, keyed above
    the largest key in use, stamped and flagged unloaded, opened as current
    Type 2 versions from ``as_of``.  (``NOT IN`` on a non-null key.)"""
    new = rows.join(dim.select(*natural_key), natural_key, "left_anti")
    keyed = _keyed(new, order, key_col, cols, base=max_key(dim, key_col))
    keyed = load_columns(keyed, flag_col, stamp, False)
    return scd_columns(keyed, as_of.date(), open_dvu)


def refresh_product_dimension(src: Sources, dim: DataFrame, as_of: _dt.datetime,
                              open_dvu: _dt.date = S.OPEN_DVU) -> DataFrame:
    return refresh_dimension(product_rows(src), dim, PRODUCT_NK, PRODUCT_ORDER, "Product_Key",
                             S.PRODUCT_DW_COLS, "PDloaded", as_of, as_of, open_dvu)


def refresh_store_dimension(src: Sources, dim: DataFrame, as_of: _dt.datetime,
                            open_dvu: _dt.date = S.OPEN_DVU) -> DataFrame:
    return refresh_dimension(store_rows(src), dim, ["StoreID"], STORE_ORDER, "Store_Key",
                             S.STORE_DW_COLS, "Sloaded", as_of, as_of, open_dvu)


def refresh_customer_dimension(src: Sources, dim: DataFrame, as_of: _dt.datetime,
                               stamp_lag_days: int = 1, open_dvu: _dt.date = S.OPEN_DVU) -> DataFrame:
    """The customer refresh stamps its extraction a day before ``as_of``."""
    stamp = as_of - _dt.timedelta(days=stamp_lag_days)
    return refresh_dimension(customer_rows(src), dim, ["CustomerID"], CUSTOMER_ORDER, "Customer_Key",
                             S.CUSTOMER_DW_COLS, "Cloaded", stamp, as_of, open_dvu)
