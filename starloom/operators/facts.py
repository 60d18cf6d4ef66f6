"""Fact extraction, key resolution, high-water mark and late-fact recovery."""

from __future__ import annotations

import dataclasses
import datetime as _dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..sources import Sources
from . import lookup
from .dims import ts


@dataclasses.dataclass(frozen=True)
class Dimensions:
    customer: DataFrame
    store: DataFrame
    product: DataFrame
    calendar: DataFrame


# A line is one product of a transaction under one revenue type.
LINE_KEY = ["TID", "RevenueType", "ProductId"]


def _money(c: Column) -> Column:
    return c.cast(S.MONEY)


def extract_sales(src: Sources, transactions: DataFrame | None = None) -> DataFrame:
    """product ⋈ soldvia ⋈ salestransaction: one intermediate row per sale line.

    ``transactions`` narrows the sales transactions (a date bound or a
    late-fact anti join); it is applied before the line join, on the
    transaction table, which is far smaller than the line table."""
    st = src.salestransaction if transactions is None else transactions
    return (src.soldvia.join(st, "tid").join(src.product.select("productid", "productprice"), "productid")
            .select(F.col("noofitems").alias("UnitSolds"),
                    _money(F.col("productprice") * F.col("noofitems")).alias("RevenueGenerated"),
                    F.lit(S.SALES).alias("RevenueType"),
                    F.col("tid").alias("TID"), F.col("productid").alias("ProductId"),
                    F.col("customerid").alias("CustomerId"), F.col("storeid").alias("StoreId"),
                    F.col("tdate").alias("FullDate")))


def extract_rentals(src: Sources, transactions: DataFrame | None = None,
                    codes: tuple[str, ...] = (S.RENTAL_CODE_DAILY, S.RENTAL_CODE_WEEKLY)) -> DataFrame:
    """rentalProducts ⋈ rentvia ⋈ rentaltransaction ⋈ customer ⋈ store.

    Customer and store only test existence (their ids are the transaction's),
    so they are semi joins on the transaction table.  Daily and weekly lines
    share one scan; the type picks the price column."""
    rt = src.rentaltransaction if transactions is None else transactions
    rt = (rt.join(src.customer.select("customerid"), "customerid", "left_semi")
          .join(src.store.select("storeid"), "storeid", "left_semi"))
    rv = src.rentvia.filter(F.col("rentaltype").isin(*codes))
    daily = F.col("rentaltype") == S.RENTAL_CODE_DAILY
    price = F.when(daily, F.col("productpricedaily")).otherwise(F.col("productpriceweekly"))
    return (rv.join(rt, "tid")
            .join(src.rentalproducts.select("productid", "productpricedaily", "productpriceweekly"), "productid")
            .select(F.lit(0).alias("UnitSolds"),
                    _money(price * F.col("duration")).alias("RevenueGenerated"),
                    F.when(daily, F.lit(S.RENTAL_DAILY)).otherwise(F.lit(S.RENTAL_WEEKLY)).alias("RevenueType"),
                    F.col("tid").alias("TID"), F.col("productid").alias("ProductId"),
                    F.col("customerid").alias("CustomerId"), F.col("storeid").alias("StoreId"),
                    F.col("tdate").alias("FullDate")))


def extract_rentals_daily(src: Sources, transactions: DataFrame | None = None) -> DataFrame:
    return extract_rentals(src, transactions, (S.RENTAL_CODE_DAILY,))


def extract_rentals_weekly(src: Sources, transactions: DataFrame | None = None) -> DataFrame:
    return extract_rentals(src, transactions, (S.RENTAL_CODE_WEEKLY,))


def high_water_mark(fact: DataFrame) -> DataFrame:
    """One row: the latest extraction date in the fact (NULL when empty)."""
    return fact.agg(F.max(F.to_date("ExtractionTimestamp")).alias("HighWaterMark"))


def after_mark(transactions: DataFrame, mark: Column | _dt.date | None) -> DataFrame:
    """Transactions dated strictly after the mark.  A NULL mark (empty fact)
    selects nothing, as ``tdate > NULL`` is never true."""
    m = mark if isinstance(mark, Column) else F.lit(mark).cast("date")
    return transactions.filter(F.col("tdate") > m)


def unkept(lines: DataFrame) -> DataFrame:
    return lines


def intermediate_fact(src: Sources, mark: Column | _dt.date | None = None, bounded: bool = False,
                      keep: Callable[[DataFrame], DataFrame] = unkept) -> DataFrame:
    """Sales, daily and weekly rental lines appended (UNION ALL).

    ``bounded`` applies the high-water mark to both transaction tables, and
    keeps only their lines: a semi join on ``tid`` goes below a grouping by
    ``tid``, so where lines are summed first the others are not held for it.

    ``keep`` may write the lines of each kind and return what it wrote, so that
    the shuffles of the two kinds, and of what follows, don't fill disk together."""
    st, rt = src.salestransaction, src.rentaltransaction
    if bounded:
        st, rt = after_mark(st, mark), after_mark(rt, mark)
        src = src.replace(soldvia=src.soldvia.join(st.select("tid"), "tid", "left_semi"),
                          rentvia=src.rentvia.join(rt.select("tid"), "tid", "left_semi"))
    return keep(extract_sales(src, st)).unionByName(keep(extract_rentals(src, rt)))


# Natural key, surrogate key and the intermediate column of each dimension
# whose rows may have a history.
_HISTORY = {"customer": ("CustomerID", "Customer_Key", "CustomerId"), "store": ("StoreID", "Store_Key", "StoreId"),
            "product": ("ProductId", "Product_Key", "ProductId")}
_EVER = "0001-01-01"


def _versions(dims: Dimensions, name: str, as_of_lookup: bool) -> DataFrame:
    """A dimension ready to be looked up: its keys and, for an as-of lookup of
    a dimension with a history, from when to when (inclusive) each row holds.
    The first version of a member also holds for all earlier dates: a line may
    be older than the registration of its product."""
    dim = getattr(dims, name)
    natural, key, _ = _HISTORY[name]
    cols = [F.col(natural).alias(f"_{name}_id"), F.col(key)]
    member = [natural]
    if name == "product":
        cols.append(F.left("ProductType", F.lit(1)).alias("_kind"))
        member = [natural, "ProductType"]
    if as_of_lookup and "DVF" in dim.columns:
        first = F.row_number().over(Window.partitionBy(*member).orderBy("DVF", key)) == 1
        cols += [F.when(first, F.lit(_EVER).cast("date")).otherwise(F.col("DVF")).alias(f"_{name}_from"), F.col("DVU").alias(f"_{name}_until")]
    return dim.select(*cols)


def _holds(lines: DataFrame, versions: DataFrame, name: str) -> Column:
    """The join condition of a line and a row from :func:`_versions`."""
    cond = lines[_HISTORY[name][2]] == versions[f"_{name}_id"]
    if name == "product":
        cond = cond & (F.left(lines.RevenueType, F.lit(1)) == versions._kind)
    if f"_{name}_from" in versions.columns:
        cond = cond & lines.FullDate.between(versions[f"_{name}_from"], versions[f"_{name}_until"])
    return cond


def _carried(lines: DataFrame, versions: DataFrame, name: str, hot: DataFrame | None) -> DataFrame:
    member = [_HISTORY[name][2]]
    versions = versions.withColumnRenamed(f"_{name}_id", member[0])
    if name == "product":
        lines, member = lines.withColumn("_kind", F.left("RevenueType", F.lit(1))), [*member, "_kind"]
    return lookup.carry_forward(lines, versions, member, "FullDate", f"_{name}_from", f"_{name}_until", _HISTORY[name][1], hot).drop("_kind")


def resolve_fact_keys(inter: DataFrame, dims: Dimensions, as_of: _dt.datetime,
                      as_of_lookup: bool = True, carried: tuple[str, ...] = (), hot: dict[str, DataFrame] | None = None) -> DataFrame:
    """Natural keys → surrogate keys; stamp ``as_of``, flag unloaded.

    Lines with no match in a dimension drop (see :func:`unresolved_facts`).
    The product match also requires the first letter of the product type to
    equal that of the revenue type (Sales/Rental).  Where a dimension has a
    history, the version valid on the transaction date is taken;
    ``as_of_lookup=False`` is the original's literal lookup, in which a line
    meets every version.

    ``carried`` names dimensions with a history too large to broadcast: their
    versions are carried forward to the lines instead of joined by interval.
    ``hot`` gives, by dimension, the members with very many lines
    (:func:`lookup.hot_members`); they are looked up apart from the rest, if the
    dimension is carried or has one row a member."""
    # smallest dimensions first, customers last: a dimension too large to
    # broadcast shuffles the fact, and the later that happens the fewer
    # columns and rows travel
    out = inter.join(dims.calendar.select("FullDate", "Calendar_Key"), "FullDate")
    for name in ("store", "product", "customer"):
        versions = _versions(dims, name, as_of_lookup)
        members = (hot or {}).get(name)
        if name in carried and f"_{name}_from" in versions.columns:
            out = _carried(out, versions, name, members)
        elif members is not None and name != "product" and f"_{name}_from" not in versions.columns:
            out = lookup.split_lookup(out, versions, _HISTORY[name][2], f"_{name}_id", members)
        else:
            out = out.join(versions, _holds(out, versions, name))
    return out.select(*[F.col(c) for c in S.FACT_DW_COLS],
                      ts(as_of).alias("ExtractionTimestamp"), F.lit(False).alias("f_loaded"))


def unresolved_facts(inter: DataFrame, dims: Dimensions, as_of_lookup: bool = True) -> DataFrame:
    """Intermediate lines that key resolution drops, with the first failing lookup."""
    out = inter.join(dims.calendar.select("FullDate").distinct().withColumn("_d", F.lit(True)), "FullDate", "left")
    found = {}
    for name in ("customer", "store", "product"):
        versions = _versions(dims, name, as_of_lookup).drop(_HISTORY[name][1]).distinct().withColumn(f"_{name}", F.lit(True))
        out = out.join(versions, _holds(out, versions, name), "left")
        found[name] = F.col(f"_{name}").isNull()
    reason = (F.when(found["customer"], F.lit("customer")).when(found["store"], F.lit("store"))
              .when(F.col("_d").isNull(), F.lit("calendar")).when(found["product"], F.lit("product")))
    return (out.withColumn("Reason", reason).filter(F.col("Reason").isNotNull())
            .select(*S.INTERMEDIATE_COLS, "Reason"))


def loaded_tids(fact: DataFrame, rental: bool) -> DataFrame:
    """Distinct TIDs already in the fact as sales, or as rentals (``R%``).

    The distinct is a partial (map-side) aggregate keyed on TID: the lines of
    a transaction collapse before the shuffle, and the anti join that follows
    reuses the aggregate's partitioning."""
    cond = F.col("RevenueType").startswith("R") if rental else (F.col("RevenueType") == S.SALES)
    return fact.filter(cond).select(F.col("TID").alias("tid")).distinct()


def late_facts(src: Sources, fact: DataFrame | None = None, sales_tids: DataFrame | None = None,
               rental_tids: DataFrame | None = None) -> DataFrame:
    """Lines of transactions with no fact of their kind yet, at any date.

    Transaction grain: a sale TID with any ``Sales`` fact, or a rental TID
    with any rental fact, is considered loaded.  The loaded TIDs come from
    ``fact``, or ready-made (``sales_tids``/``rental_tids``, column ``tid``),
    e.g. from an index bucketed by TID so that only the source side of the
    anti join is shuffled."""
    if sales_tids is None:
        sales_tids = loaded_tids(fact, rental=False)
    if rental_tids is None:
        rental_tids = loaded_tids(fact, rental=True)
    st = src.salestransaction.join(sales_tids, "tid", "left_anti")
    rt = src.rentaltransaction.join(rental_tids, "tid", "left_anti")
    return extract_sales(src, st).unionByName(extract_rentals(src, rt))


def not_yet_loaded(lines: DataFrame, fact: DataFrame, product_dim: DataFrame) -> DataFrame:
    """Refuse intermediate lines that the fact holds already: same transaction,
    revenue type and product, in any version of the product (a rerun, or a
    transaction dated after the mark and loaded before).  A line entered later
    for a loaded transaction passes."""
    loaded = (fact.select("TID", "RevenueType", "Product_Key").join(product_dim.select("Product_Key", "ProductId"), "Product_Key")
              .select(*LINE_KEY).distinct())
    return lines.join(loaded, LINE_KEY, "left_anti").select(*lines.columns)
