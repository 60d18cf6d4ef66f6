"""Aggregate and snapshot marts over the revenue fact.

The daily store snapshot is computed in one pass over the fact: lines are
first aggregated per (day, store, transaction) — which spreads a hot store-day
over its transactions — and then per (day, store), where the distinct
transaction count and the high-value count become plain counts.  Between loads
it is kept in an additive form, to which each load adds what it changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..config import DEFAULT, Params
from ..functions import avg_half_up, money
from .facts import Dimensions
from .keys import assign_surrogate_keys

GRAIN = ["Calendar_Key", "Store_Key"]


def _tracked_keys(product_dim: DataFrame, category: str) -> DataFrame:
    return (product_dim.filter(F.col("Categoryname") == category)
            .select("Product_Key").distinct().withColumn("_tracked", F.lit(True)))


def _zip_prefixes(dims: Dimensions, n: int) -> tuple[DataFrame, DataFrame]:
    sz = dims.store.select("Store_Key", F.left("StoreZip", F.lit(n)).alias("_sp")).distinct()
    cz = dims.customer.select("Customer_Key", F.left("CustomerZip", F.lit(n)).alias("_cp")).distinct()
    return sz, cz


def daily_store_snapshot_base(fact: DataFrame) -> DataFrame:
    """Per day and store: units, revenue, distinct transactions, average
    revenue per fact line that has one (halves away from zero, to cents)."""
    per_tx = (fact.groupBy(*GRAIN, "TID")
              .agg(F.count("RevenueGenerated").alias("_n"), F.sum("UnitSolds").alias("_u"),
                   F.sum("RevenueGenerated").alias("_r")))
    agg = (per_tx.groupBy(*GRAIN)
           .agg(F.sum("_u").cast("long").alias("TotalUnitSold"),
                money(F.sum("_r")).alias("TotalRevenueGenerated"),
                F.count(F.lit(1)).cast("long").alias("TotalNumberOfTransactions"),
                F.sum("_n").alias("_lines")))
    return agg.select("TotalUnitSold", "TotalRevenueGenerated", "TotalNumberOfTransactions",
                      avg_half_up("TotalRevenueGenerated", "_lines").alias("AverageRevenueGenerated"),
                      *GRAIN)


def _per_transaction(fact: DataFrame, dims: Dimensions, params: Params) -> DataFrame:
    """One row per (day, store, transaction) with its measures.

    Lines are reduced to (transaction, customer) rows before the customer and
    store lookups of the local measure, so those joins move transaction rows,
    not line rows; a hot store-day is spread over its transactions.  Lines are
    dealt by (day, store, transaction) once, which both aggregates share."""
    rev = F.col("RevenueGenerated")
    lines = fact.join(_tracked_keys(dims.product, params.tracked_category), "Product_Key", "left")
    # 1) lines → (transaction, customer)
    per_tc = (lines.select(*GRAIN, "TID", "Customer_Key", rev, "UnitSolds", "_tracked").repartition(*GRAIN, "TID")
              .groupBy(*GRAIN, "TID", "Customer_Key")
              .agg(F.count(rev).alias("_n"), F.sum("UnitSolds").alias("_u"), F.sum(rev).alias("_r"),
                   F.sum(F.when(F.col("_tracked"), rev)).alias("_fw"),
                   F.max(rev > params.high_value).alias("_hv")))
    # 2) zip lookups on transaction rows
    sz, cz = _zip_prefixes(dims, params.zip_prefix)
    per_tc = (per_tc.join(sz, "Store_Key", "left").join(cz, "Customer_Key", "left")
              .withColumn("_lr", F.when(F.col("_sp") == F.col("_cp"), F.col("_r"))))
    # 3) one row per transaction, so the distinct counts become plain counts
    return (per_tc.groupBy(*GRAIN, "TID")
            .agg(F.sum("_n").alias("_n"), F.sum("_u").alias("_u"), F.sum("_r").alias("_r"),
                 F.sum("_fw").alias("_fw"), F.sum("_lr").alias("_lr"), F.max("_hv").alias("_hv")))


#: What the snapshot is kept as between loads: sums and counts only, which add up.
STATE_COLS = ["Units", "Revenue", "Lines", "Transactions", "Tracked", "HighValue", "Local"]


def _state(per_tx: DataFrame, counts, high) -> DataFrame:
    return (per_tx.groupBy(*GRAIN)
            .agg(F.sum("_u").cast("long").alias("Units"), money(F.sum("_r")).alias("Revenue"), F.sum("_n").cast("long").alias("Lines"),
                 F.count(F.when(counts, F.lit(1))).cast("long").alias("Transactions"), money(F.sum("_fw")).alias("Tracked"),
                 F.count(F.when(high, F.lit(1))).cast("long").alias("HighValue"), money(F.sum("_lr")).alias("Local")))


def snapshot_state(fact: DataFrame, dims: Dimensions, params: Params = DEFAULT) -> DataFrame:
    """The additive form of the snapshot: per day and store, sums and counts."""
    return _state(_per_transaction(fact, dims, params), F.lit(True), F.col("_hv"))


def snapshot_delta(new: DataFrame, earlier: DataFrame, dims: Dimensions, params: Params = DEFAULT) -> DataFrame:
    """What the fact rows of a load add to the state of the earlier rows, for the
    days and stores the load touches.  Sums add up; a transaction that already
    has earlier rows on that day in that store isn't counted again, nor is one
    that was of high value before.  Of ``earlier`` only rows of the same days and
    stores matter, so the caller may pass less than all (the months the load
    touches); they meet the load's rows in one aggregation by transaction."""
    rev = F.col("RevenueGenerated")
    mine = _per_transaction(new, dims, params).withColumn("_before", F.lit(False)).withColumn("_hv_before", F.lit(False))
    old = (earlier.groupBy(*GRAIN, "TID").agg(F.max(rev > params.high_value).alias("_hv_before")).withColumn("_before", F.lit(True)))
    both = mine.unionByName(old, allowMissingColumns=True)
    per_tx = (both.groupBy(*GRAIN, "TID")
              .agg(*[F.sum(c).alias(c) for c in ("_n", "_u", "_r", "_fw", "_lr")], F.max("_hv").alias("_hv"),
                   F.max("_before").alias("_before"), F.max("_hv_before").alias("_hv_before"), F.max(~F.col("_before")).alias("_touched"))
              .filter("_touched"))
    return _state(per_tx, ~F.col("_before"), F.col("_hv") & ~F.coalesce("_hv_before", F.lit(False)))


def merge_states(states: DataFrame) -> DataFrame:
    """States of the same days and stores added up."""
    sums = {"Units": "long", "Revenue": S.MONEY, "Lines": "long", "Transactions": "long", "Tracked": S.MONEY, "HighValue": "long", "Local": S.MONEY}
    return states.groupBy(*GRAIN).agg(*[F.sum(c).cast(t).alias(c) for c, t in sums.items()])


def snapshot_of_state(state: DataFrame) -> DataFrame:
    """The snapshot's columns from its additive form."""
    zero = F.lit(0).cast(S.MONEY)
    return state.select(F.col("Units").alias("TotalUnitSold"), F.col("Revenue").alias("TotalRevenueGenerated"),
                        F.col("Transactions").alias("TotalNumberOfTransactions"),
                        avg_half_up("Revenue", "Lines").alias("AverageRevenueGenerated"),
                        F.coalesce("Tracked", zero).alias("TotalFootwearRevenue"), F.col("HighValue").alias("NumberOfHVTransaction"),
                        F.coalesce("Local", zero).alias("TotalLocalRevenue"), *GRAIN)


def daily_store_snapshot(fact: DataFrame, dims: Dimensions, params: Params = DEFAULT) -> DataFrame:
    """The full snapshot: base measures plus tracked-category revenue,
    high-value transaction count and local revenue, 0 where absent."""
    return snapshot_of_state(snapshot_state(fact, dims, params))


def update_join(target: DataFrame, helper: DataFrame, target_col: str, helper_col: str,
                keys: list[str] = GRAIN) -> DataFrame:
    """``UPDATE target t, helper h SET t.c = h.c WHERE keys match`` on a column
    added with a default: matched rows take the helper's value, others keep
    theirs (a left join and a coalesce, copy-on-write)."""
    h = helper.select(*keys, F.col(helper_col).alias("_upd"))
    return (target.join(h, keys, "left")
            .withColumn(target_col, F.coalesce(F.col("_upd").cast(target.schema[target_col].dataType),
                                               F.col(target_col)))
            .select(*target.columns))


def daily_store_snapshot_update_joins(fact: DataFrame, dims: Dimensions, params: Params = DEFAULT) -> DataFrame:
    """The snapshot in the original's shape: the base table, three measure
    columns added with default 0, each set by an update join from its helper
    table.  Equal to :func:`daily_store_snapshot`, which needs one pass."""
    zero = F.lit(0).cast(S.MONEY)
    snap = (daily_store_snapshot_base(fact)
            .withColumn("TotalFootwearRevenue", zero)
            .withColumn("NumberOfHVTransaction", F.lit(0).cast("long"))
            .withColumn("TotalLocalRevenue", zero))
    snap = update_join(snap, footwear_revenue(fact, dims.product, params.tracked_category),
                       "TotalFootwearRevenue", "TotalFootwearRevenue")
    snap = update_join(snap, hv_transactions(fact, params.high_value), "NumberOfHVTransaction",
                       "HVTransactionCount")
    snap = update_join(snap, local_revenue(fact, dims, params.zip_prefix), "TotalLocalRevenue", "TotalLocalRevenue")
    return snap.select("TotalUnitSold", "TotalRevenueGenerated", "TotalNumberOfTransactions",
                       "AverageRevenueGenerated", "TotalFootwearRevenue", "NumberOfHVTransaction",
                       "TotalLocalRevenue", *GRAIN)


def footwear_revenue(fact: DataFrame, product_dim: DataFrame, category: str) -> DataFrame:
    """Revenue of one category per day and store (groups without it absent):
    lines of other categories go before anything is grouped."""
    keys = product_dim.filter(F.col("Categoryname") == category).select("Product_Key")
    return (fact.join(keys, "Product_Key", "left_semi").groupBy(*GRAIN)
            .agg(money(F.sum("RevenueGenerated")).alias("TotalFootwearRevenue"))
            .select("TotalFootwearRevenue", *GRAIN))


def hv_transactions(fact: DataFrame, threshold: int) -> DataFrame:
    """Transactions with at least one line above ``threshold``, per day and store."""
    return (fact.filter(F.col("RevenueGenerated") > threshold)
            .groupBy(*GRAIN).agg(F.countDistinct("TID").cast("long").alias("HVTransactionCount"))
            .select("HVTransactionCount", *GRAIN))


def local_revenue(fact: DataFrame, dims: Dimensions, n: int) -> DataFrame:
    """Revenue where store and customer zip codes share their first ``n``
    characters; the lookups carry the prefixes and the test comes before the
    grouping."""
    sz = dims.store.select("Store_Key", F.left("StoreZip", F.lit(n)).alias("_sp"))
    cz = dims.customer.select("Customer_Key", F.left("CustomerZip", F.lit(n)).alias("_cp"))
    return (fact.join(sz, "Store_Key").join(cz, "Customer_Key").filter(F.col("_sp") == F.col("_cp"))
            .groupBy(*GRAIN).agg(money(F.sum("RevenueGenerated")).alias("TotalLocalRevenue"))
            .select("TotalLocalRevenue", *GRAIN))


def one_way_revenue_by_category(fact: DataFrame, product_dim: DataFrame, cat_dim: DataFrame) -> DataFrame:
    """Fact rolled up from product to product category, other keys kept.  The
    category is looked up first: with the other keys kept, a product hardly
    occurs twice in a group, so there is nothing to sum before the lookup."""
    pc = (product_dim.select("Product_Key", "CategoryID", "Categoryname")
          .join(cat_dim.select("Product_cat_Key", "CategoryID", "Categoryname"),
                ["CategoryID", "Categoryname"]).select("Product_Key", "Product_cat_Key"))
    return (fact.join(pc, "Product_Key")
            .groupBy("Calendar_Key", "Customer_Key", "Store_Key", "Product_cat_Key")
            .agg(F.sum("UnitSolds").cast("long").alias("TotalUnitSold"),
                 money(F.sum("RevenueGenerated")).alias("TotalRevenueGenerated")))


def revenue_by_month_region(fact: DataFrame, dims: Dimensions) -> DataFrame:
    """Revenue, units and transactions by month and region (reduced to
    (day, store, transaction) before the calendar and store lookups)."""
    per_tx = (fact.groupBy("Calendar_Key", "Store_Key", "TID")
              .agg(F.sum("RevenueGenerated").alias("_r"), F.sum("UnitSolds").alias("_u")))
    cal = dims.calendar.select("Calendar_Key", "CalendarYear", "CalendarMonth")
    st = dims.store.select("Store_Key", "RegionName")
    return (per_tx.join(cal, "Calendar_Key").join(st, "Store_Key")
            .groupBy("CalendarYear", "CalendarMonth", "RegionName")
            .agg(money(F.sum("_r")).alias("TotalRevenueGenerated"),
                 F.sum("_u").cast("long").alias("TotalUnitSold"),
                 F.countDistinct("TID").cast("long").alias("TotalNumberOfTransactions")))


def revenue_by_product_type(fact: DataFrame, product_dim: DataFrame) -> DataFrame:
    """Revenue by revenue type, product type and category (reduced to one row
    per product and revenue type before the product lookup)."""
    per_product = (fact.groupBy("RevenueType", "Product_Key")
                   .agg(F.sum("RevenueGenerated").alias("_r"), F.sum("UnitSolds").alias("_u"),
                        F.count(F.lit(1)).alias("_n")))
    pd_ = product_dim.select("Product_Key", "ProductType", "Categoryname")
    return (per_product.join(pd_, "Product_Key")
            .groupBy("RevenueType", "ProductType", "Categoryname")
            .agg(money(F.sum("_r")).alias("TotalRevenueGenerated"),
                 F.sum("_u").cast("long").alias("TotalUnitSold"),
                 F.sum("_n").cast("long").alias("FactLines")))


#: Levels of :func:`revenue_rollups`, each with the columns it is grouped by.
LEVELS = [["CalendarYear", "CalendarMonth", "RegionName", "Categoryname"], ["CalendarYear", "CalendarMonth", "RegionName"],
          ["CalendarYear", "RegionName"], ["CalendarYear", "Categoryname"], ["CalendarYear"], ["RegionName"], ["Categoryname"], []]


def number_transactions(fact: DataFrame) -> DataFrame:
    """``TID, _no``: dense numbers from 1 in the order of days, so that the
    transactions of a month have neighbouring numbers."""
    tids = fact.groupBy("TID").agg(F.min("Calendar_Key").alias("_day"))
    return assign_surrogate_keys(tids, [("_day", True), ("TID", True)], "_no").select("TID", "_no")


def revenue_rollups(fact: DataFrame, dims: Dimensions) -> DataFrame:
    """Revenue, units and distinct transactions at all :data:`LEVELS` at once;
    columns that a level lacks are NULL there, ``Level`` tells which they are
    (the grouping id of year, month, region, category).

    A transaction has lines of several categories, so its counts don't add up
    over them.  Each group's transactions are kept as bitmaps over their dense
    numbers, 4 KiB for each 32,768 numbers that occur in it; the levels are
    grouping sets over these partial states, merged bit by bit, not over lines."""
    cal = dims.calendar.select("Calendar_Key", "CalendarYear", "CalendarMonth")
    lines = (fact.select("Calendar_Key", "Store_Key", "Product_Key", "TID", "RevenueGenerated", "UnitSolds")
             .join(number_transactions(fact), "TID").join(cal, "Calendar_Key")
             .join(dims.store.select("Store_Key", "RegionName"), "Store_Key")
             .join(dims.product.select("Product_Key", "Categoryname"), "Product_Key"))
    keys = LEVELS[0]
    states = (lines.groupBy(*keys, F.bitmap_bucket_number("_no").alias("_bucket"))
              .agg(F.sum("RevenueGenerated").alias("_r"), F.sum("UnitSolds").alias("_u"), F.bitmap_construct_agg(F.bitmap_bit_position("_no")).alias("_t")))
    merged = (states.groupingSets([[*level, "_bucket"] for level in LEVELS], *keys, "_bucket")
              .agg(F.expr("grouping(CalendarYear) * 8 + grouping(CalendarMonth) * 4 + grouping(RegionName) * 2 + grouping(Categoryname)").alias("Level"),
                   F.sum("_r").alias("_r"), F.sum("_u").alias("_u"), F.bitmap_count(F.bitmap_or_agg("_t")).alias("_t")))
    return (merged.groupBy("Level", *keys)
            .agg(money(F.sum("_r")).alias("TotalRevenueGenerated"), F.sum("_u").cast("long").alias("TotalUnitSold"),
                 F.sum("_t").cast("long").alias("TotalNumberOfTransactions"))
            .withColumn("Level", F.col("Level").cast("int")))


def _revenue_by(fact: DataFrame, member: str) -> DataFrame:
    """Revenue, units and transactions of each member of one dimension: lines
    are reduced to one row a transaction first, which spreads a member with very
    many lines, and the transactions are then counted."""
    per_tx = fact.groupBy(member, "TID").agg(F.sum("RevenueGenerated").alias("_r"), F.sum("UnitSolds").alias("_u"))
    return (per_tx.groupBy(member).agg(money(F.sum("_r")).alias("TotalRevenueGenerated"), F.sum("_u").cast("long").alias("TotalUnitSold"),
                                       F.count(F.lit(1)).alias("TotalNumberOfTransactions")))


def revenue_by_customer(fact: DataFrame, customer_dim: DataFrame) -> DataFrame:
    return _revenue_by(fact, "Customer_Key").join(customer_dim.select("Customer_Key", "CustomerID", "CustomerName"), "Customer_Key")


def revenue_by_store(fact: DataFrame, store_dim: DataFrame) -> DataFrame:
    return _revenue_by(fact, "Store_Key").join(store_dim.select("Store_Key", "StoreID", "RegionName"), "Store_Key")
