"""Adapter from the TPC-H-like fixture tables to the eleven operational tables.

The fixture tables carry none of the warehouse's names; the views below map
them deterministically (the same definitions are written in SQL for the
DuckDB oracle in :mod:`starloom.plans.oracle`).  ``arrival`` selects which
orders the operational system holds at a given moment of the test scenario
(see :class:`starloom.config.Params`); ``changed`` applies the scenario's
product edits that drive the Type 2 history.
"""

from __future__ import annotations

import datetime as _dt
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..config import DEFAULT, Params
from ..functions.clock import ts
from .model import Sources

#: Lines that one task sorts and sums, at most about, and the number of such parts
#: from which the lines are dealt out by it.
LINES_PER_TASK, FEW_PARTS = 500_000, 16

FIXTURE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _s(prefix: str, c: str | Column) -> Column:
    return F.concat(F.lit(prefix), F.col(c).cast("string") if isinstance(c, str) else c.cast("string"))


def _zip(region_part: str, key: str) -> Column:
    return F.concat(F.lpad(F.col(region_part).cast("string"), 2, "0"),
                    F.lpad((F.col(key) % 1000).cast("string"), 3, "0"))


def _vendor_id(brand: Column) -> Column:
    return F.replace(brand, F.lit("Brand#"), F.lit(""))


def arrival_filter(params: Params, arrival: str) -> Column | None:
    """Orders present in the operational system at a moment of the scenario."""
    if arrival == "full":
        return None
    next_day = _dt.datetime.combine(params.base_cutoff + _dt.timedelta(days=1), _dt.time())
    on_or_before = F.col("o_orderdate") < ts(next_day)
    if arrival == "base":
        return on_or_before & (F.col("o_orderkey") % params.late_every != 0)
    raise ValueError(f"unknown arrival {arrival!r}")


def transaction_parts(spark: SparkSession, lines: int) -> int | None:
    """Parts by ``tid`` for so many lines; None if they are few, and Spark's own
    merging of small shuffle partitions leaves little to a task."""
    parts = math.ceil(lines / LINES_PER_TASK)
    # not below the session's number: the joins that follow keep these parts then
    return None if parts < FEW_PARTS else max(parts, int(spark.conf.get("spark.sql.shuffle.partitions")))


def by_transaction(rows: DataFrame, parts: int | None) -> DataFrame:
    return rows if parts is None else rows.repartition(parts, "tid")


def fixture_sources(spark: SparkSession, sf_dir: str, params: Params = DEFAULT,
                    arrival: str = "full", changed: bool = False) -> Sources:
    rd = lambda n: read_table(spark, sf_dir, n)

    supplier, nation = rd("supplier"), rd("nation")
    store = (supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
             .select(_s("S", "s_suppkey").alias("storeid"),
                     _zip("s_nationkey", "s_suppkey").alias("storezip"),
                     F.col("n_regionkey").cast("string").alias("regionid")))
    region = rd("region").select(F.col("r_regionkey").cast("string").alias("regionid"),
                                 F.col("r_name").alias("regionname"))
    customer = rd("customer").select(_s("C", "c_custkey").alias("customerid"),
                                     F.col("c_name").alias("customername"),
                                     _zip("c_nationkey", "c_custkey").alias("customerzip"))

    part = rd("part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    vendor = part.select(_vendor_id(F.col("p_brand")).alias("vendorid"),
                         F.col("p_brand").alias("vendorname")).distinct()
    category = part.select(F.left(F.col("p_type"), F.lit(2)).alias("categoryid"),
                           F.col("p_type").alias("categoryname")).distinct()

    k = F.col("p_partkey")
    price = F.col("p_retailprice").cast(S.PRICE)
    name = F.col("p_name")
    brand_no = _vendor_id(F.col("p_brand"))
    daily = (F.col("p_size") + 5).cast(S.PRICE)
    if changed:
        # Scenario edits of the source price lists (Type 2 triggers).
        price = F.when(k % 10 == 0, (price + 10).cast(S.PRICE)).otherwise(price)
        name = F.when(k % 15 == 0, F.concat(name, F.lit(" v2"))).otherwise(name)
        brand_no = F.when(k % 21 == 0, ((brand_no.cast("int") % 25) + 1).cast("string")).otherwise(brand_no)
    product = (part.filter(k % 4 != 3)
               .select(_s("P", "p_partkey").alias("productid"), name.alias("productname"),
                       price.alias("productprice"), brand_no.alias("vendorid"),
                       F.left(F.col("p_type"), F.lit(2)).alias("categoryid")))
    if changed:
        daily = F.when(k % 14 == 1, (daily + 1).cast(S.PRICE)).otherwise(daily)
    rentalproducts = (part.filter(k % 4 != 0)
                      .select(_s("P", "p_partkey").alias("productid"), F.col("p_name").alias("productname"),
                              _vendor_id(F.col("p_brand")).alias("vendorid"),
                              F.left(F.col("p_type"), F.lit(2)).alias("categoryid"),
                              daily.alias("productpricedaily"),
                              ((F.col("p_size") + 5) * 4).cast(S.PRICE).alias("productpriceweekly")))

    orders = rd("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    cond = arrival_filter(params, arrival)
    if cond is not None:
        orders = orders.filter(cond)
    n_stores = supplier.agg(F.count(F.lit(1))).scalar()
    tx = orders.select(_s("T", "o_orderkey").alias("tid"),
                       _s("C", "o_custkey").alias("customerid"),
                       F.concat(F.lit("S"), (F.col("o_orderkey") % n_stores).cast("string")).alias("storeid"),
                       F.col("o_orderdate").cast("date").alias("tdate"),
                       F.col("o_orderstatus"))
    salestransaction = tx.filter(F.col("o_orderstatus") != "P").drop("o_orderstatus")
    rentaltransaction = tx.filter(F.col("o_orderstatus") == "P").drop("o_orderstatus")

    # Lines are matched to their transactions and summed on ``tid``: with the
    # semi join hash-partitioned by ``tid``, the grouping and the extraction's
    # join with the transaction table reuse that one shuffle of the lines.
    lineitem = rd("lineitem")
    lines = lineitem.select(
        _s("T", "l_orderkey").alias("tid"), _s("P", "l_partkey").alias("productid"),
        F.round("l_quantity").cast("int").alias("qty"),
        F.when(F.col("l_linestatus") == "O", F.lit(S.RENTAL_CODE_DAILY))
         .otherwise(F.lit(S.RENTAL_CODE_WEEKLY)).alias("rentaltype"))
    # Many lines get a number of parts that grows with them and that AQE doesn't
    # merge, so what a task holds doesn't grow with the tables.  It is set on the
    # transactions (a repartition of the lines would be moved above the semi
    # join); the lines and the joins that follow take it over.
    parts = transaction_parts(spark, lineitem.count())
    soldvia = (lines.join(by_transaction(salestransaction.select("tid"), parts), "tid", "left_semi")
               .groupBy("tid", "productid").agg(F.sum("qty").cast("int").alias("noofitems"))
               .select("productid", "tid", "noofitems"))
    # one part more: of a union of tables in equally many parts, Spark runs the parts
    # of both in one task, which then holds both
    rentvia = (lines.join(by_transaction(rentaltransaction.select("tid"), parts and parts + 1), "tid", "left_semi")
               .groupBy("tid", "productid", "rentaltype").agg(F.sum("qty").cast("int").alias("duration"))
               .select("productid", "tid", "rentaltype", "duration"))

    return Sources(salestransaction=salestransaction, soldvia=soldvia,
                   rentaltransaction=rentaltransaction, rentvia=rentvia,
                   product=product, rentalproducts=rentalproducts, customer=customer,
                   store=store, region=region, vendor=vendor, category=category)
