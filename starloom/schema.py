"""Column names, type constants and fixed values of the warehouse."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import types as T

# --- Fixed values: these must equal the original warehouse's literals. ----
# Revenue types written into the fact table.
SALES = "Sales"
RENTAL_DAILY = "RentalDaily"
RENTAL_WEEKLY = "RentalWeekly"
# Product types of the product dimension.
PRODUCT_SALES = "Sales"
PRODUCT_RENTAL = "Rental"
# Rental line codes in the rental line table.
RENTAL_CODE_DAILY = "D"
RENTAL_CODE_WEEKLY = "W"
# Type 2 status flags: current / not current.
STATUS_CURRENT = "C"
STATUS_EXPIRED = "N"
# Open end of a validity interval, and the default start used when the
# history columns are first added.
OPEN_DVU = _dt.date(2040, 1, 1)
DEFAULT_DVF = _dt.date(2013, 1, 1)
# Snapshot measures: high-value line threshold (strict >), zip prefix length.
HIGH_VALUE_THRESHOLD = 100
ZIP_PREFIX_LEN = 2
# Category whose revenue the snapshot tracks separately.
TRACKED_CATEGORY = "Footwear"
# Declared CHAR/VARCHAR limits of the warehouse tables (table, column, n).
LENGTH_LIMITS = [
    ("Customer_Dimension", "CustomerID", 8),
    ("Customer_Dimension", "CustomerName", 15),
    ("Customer_Dimension", "CustomerZip", 8),
    ("Store_Dimension", "StoreZip", 5),
    ("Store_Dimension", "RegionID", 1),
    ("Store_Dimension", "RegionName", 25),
    ("Store_Dimension", "StoreID", 3),
    ("Product_Dimension", "Productname", 25),
    ("Product_Dimension", "VendorId", 2),
    ("Product_Dimension", "Vendorname", 25),
    ("Product_Dimension", "Categoryname", 25),
    ("Product_Dimension", "CategoryID", 2),
    ("Product_Dimension", "ProductType", 10),
    ("Product_Dimension", "ProductId", 3),
    ("RevenueFact", "TID", 8),
    ("RevenueFact", "RevenueType", 20),
]
# --- end of fixed values ---------------------------------------------------

PRICE = T.DecimalType(7, 2)
MONEY = T.DecimalType(18, 2)
AVG_MONEY = T.DecimalType(10, 2)

# Columns of the published (DW) fact table, in order.
FACT_DW_COLS = [
    "RevenueGenerated", "UnitSolds", "RevenueType", "TID",
    "Customer_Key", "Store_Key", "Product_Key", "Calendar_Key",
]
# The staging (DS) fact adds the load stamp and the loaded flag.
FACT_DS_COLS = FACT_DW_COLS + ["ExtractionTimestamp", "f_loaded"]
# Natural key of a fact line, used to refuse re-extraction.
FACT_KEY = ["TID", "RevenueType", "Customer_Key", "Store_Key", "Product_Key", "Calendar_Key"]

INTERMEDIATE_COLS = [
    "UnitSolds", "RevenueGenerated", "RevenueType", "TID",
    "ProductId", "CustomerId", "StoreId", "FullDate",
]

CUSTOMER_DW_COLS = ["Customer_Key", "CustomerID", "CustomerName", "CustomerZip"]
STORE_DW_COLS = ["Store_Key", "StoreID", "StoreZip", "RegionID", "RegionName"]
PRODUCT_DW_COLS = [
    "Product_Key", "ProductId", "Productname", "VendorId", "Vendorname",
    "CategoryID", "Categoryname", "ProductSalesPrice", "ProductDailyRentalPrice",
    "ProductWeeklyRental", "ProductType",
]
CALENDAR_COLS = ["Calendar_Key", "FullDate", "CalendarMonth", "CalendarYear"]
SCD_COLS = ["DVF", "DVU", "CurrentStatus"]

# Columns compared by the Type 2 change detection, per product type.
TRACKED_SALES = [("productprice", "ProductSalesPrice"), ("productname", "Productname"),
                 ("vendorid", "VendorId")]
TRACKED_RENTAL = [("productpriceweekly", "ProductWeeklyRental"), ("productname", "Productname"),
                  ("vendorid", "VendorId"), ("productpricedaily", "ProductDailyRentalPrice")]

# Source (OLTP) tables and their columns.
SOURCE_COLUMNS = {
    "salestransaction": ["tid", "customerid", "storeid", "tdate"],
    "soldvia": ["productid", "tid", "noofitems"],
    "rentaltransaction": ["tid", "customerid", "storeid", "tdate"],
    "rentvia": ["productid", "tid", "rentaltype", "duration"],
    "product": ["productid", "productname", "productprice", "vendorid", "categoryid"],
    "rentalproducts": ["productid", "productname", "vendorid", "categoryid",
                       "productpricedaily", "productpriceweekly"],
    "customer": ["customerid", "customername", "customerzip"],
    "store": ["storeid", "storezip", "regionid"],
    "region": ["regionid", "regionname"],
    "vendor": ["vendorid", "vendorname"],
    "category": ["categoryid", "categoryname"],
}

SOURCE_SCHEMAS = {
    "salestransaction": "tid string, customerid string, storeid string, tdate date",
    "soldvia": "productid string, tid string, noofitems int",
    "rentaltransaction": "tid string, customerid string, storeid string, tdate date",
    "rentvia": "productid string, tid string, rentaltype string, duration int",
    "product": "productid string, productname string, productprice decimal(7,2), "
               "vendorid string, categoryid string",
    "rentalproducts": "productid string, productname string, vendorid string, categoryid string, "
                      "productpricedaily decimal(7,2), productpriceweekly decimal(7,2)",
    "customer": "customerid string, customername string, customerzip string",
    "store": "storeid string, storezip string, regionid string",
    "region": "regionid string, regionname string",
    "vendor": "vendorid string, vendorname string",
    "category": "categoryid string, categoryname string",
}
