"""Type 2 history for the product dimension (and, by argument, others).

detect → expire → new versions → upsert.  Detection compares the tracked
columns of the source with the *current* dimension rows; expiry closes only
current rows of the changed (ProductId, ProductType); new versions open on
the change date with fresh surrogate keys above the largest key in use."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..session import ensure_checkpoint_dir
from ..sources import Sources
from . import dims as D
from .keys import assign_surrogate_keys, max_key


def initialise(dim: DataFrame, dvf: _dt.date, dvu: _dt.date = S.OPEN_DVU) -> DataFrame:
    """Add DVF/DVU/CurrentStatus to every row: all current from ``dvf``."""
    return D.scd_columns(dim, dvf, dvu, S.STATUS_CURRENT)


def detect(rows: DataFrame, dim: DataFrame, key: list[str], tracked: list[str]) -> DataFrame:
    """Generic detection: natural keys whose current row differs from the
    source rows (same column names) in any tracked column; NULLs never
    differ, as with SQL ``!=``.  Serves customers and stores as well."""
    cur = dim.filter(F.col("CurrentStatus") == S.STATUS_CURRENT)
    differs = None
    for c in tracked:
        d = F.col(f"s.{c}") != F.col(f"d.{c}")
        differs = d if differs is None else (differs | d)
    on = [F.col(f"s.{k}") == F.col(f"d.{k}") for k in key]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return (rows.alias("s").join(cur.alias("d"), cond).filter(differs)
            .select(*[F.col(f"s.{k}").alias(k) for k in key]).distinct())


#: Ranges of members whose digests are compared.
DIGEST_RANGES = 4096


def _range_of(key: list[str], ranges: int):
    return F.pmod(F.xxhash64(*key), F.lit(ranges)).cast("int")


def _digests(rows: DataFrame, key: list[str], tracked: list[str], ranges: int) -> DataFrame:
    """Per range of members: their number, and two digests of all compared
    values, which don't depend on the order (64 bits xor-ed, and a sum of other
    64 bits).  Aggregated map-side: one row a range and task is shuffled."""
    values = [*[F.col(c) for c in (*key, *tracked)], *[F.col(c).isNull() for c in tracked]]
    return (rows.groupBy(_range_of(key, ranges).alias("_range"))
            .agg(F.count(F.lit(1)).alias("_n"), F.bit_xor(F.xxhash64(*values)).alias("_x"),
                 F.sum(F.xxhash64(F.lit("sum"), *values).cast("decimal(20,0)")).alias("_s")))


def differing_ranges(rows: DataFrame, dim: DataFrame, key: list[str], tracked: list[str], ranges: int = DIGEST_RANGES) -> DataFrame:
    """``_range``: the ranges whose source rows and current dimension rows
    aren't the same set of values, at most ``ranges`` rows."""
    cur = dim.filter(F.col("CurrentStatus") == S.STATUS_CURRENT)
    a, b = _digests(rows, key, tracked, ranges).alias("a"), _digests(cur, key, tracked, ranges).alias("b")
    same = F.lit(True)
    for c in ("_n", "_x", "_s"):
        same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    return a.join(b, F.col("a._range") == F.col("b._range"), "full").filter(~same).select(F.coalesce("a._range", "b._range").alias("_range"))


def in_ranges(rows: DataFrame, key: list[str], found: DataFrame, ranges: int = DIGEST_RANGES) -> DataFrame:
    return rows.join(F.broadcast(found), _range_of(key, ranges) == F.col("_range"), "left_semi")


def detect_by_digest(rows: DataFrame, dim: DataFrame, key: list[str], tracked: list[str], ranges: int = DIGEST_RANGES) -> DataFrame:
    """What :func:`detect` finds, without joining members of ranges in which
    nothing has changed: only the rows of differing ranges are shuffled."""
    found = differing_ranges(rows, dim, key, tracked, ranges).checkpoint(eager=True)
    return detect(in_ranges(rows, key, found, ranges), in_ranges(dim, key, found, ranges), key, tracked)


#: All compared columns of products; those of the other type are NULL and never differ.
TRACKED_PRODUCTS = ["Productname", "VendorId", "ProductSalesPrice", "ProductDailyRentalPrice", "ProductWeeklyRental"]


def detect_product_changes_by_digest(src: Sources, dim: DataFrame) -> DataFrame:
    """(ProductId, ProductType) whose current row differs from the source."""
    ensure_checkpoint_dir(dim.sparkSession)
    return detect_by_digest(D.product_rows(src), dim, D.PRODUCT_NK, TRACKED_PRODUCTS)


def _changed(rows: DataFrame, dim: DataFrame, ptype: str, tracked: list[tuple[str, str]]) -> DataFrame:
    cur = dim.filter((F.col("ProductType") == ptype) & (F.col("CurrentStatus") == S.STATUS_CURRENT))
    src_cols = {dst: F.col(f"s.{dst}") for _, dst in tracked}
    differs = None
    for _, dst in tracked:
        # `!=` as in SQL: a NULL on either side is not a change
        d = src_cols[dst] != F.col(f"d.{dst}")
        differs = d if differs is None else (differs | d)
    return (rows.alias("s").join(cur.alias("d"), F.col("s.ProductId") == F.col("d.ProductId"))
            .filter(differs)
            .select(F.col("s.ProductId").alias("ProductId"), F.lit(ptype).alias("ProductType"))
            .distinct())


def detect_changes(src: Sources, dim: DataFrame,
                   tracked_sales=S.TRACKED_SALES, tracked_rental=S.TRACKED_RENTAL) -> DataFrame:
    """(ProductId, ProductType) whose current row differs from the source."""
    return (_changed(D.product_sales_rows(src), dim, S.PRODUCT_SALES, tracked_sales)
            .unionByName(_changed(D.product_rental_rows(src), dim, S.PRODUCT_RENTAL, tracked_rental)))


def expire(dim: DataFrame, changed: DataFrame, as_of: _dt.datetime, key: list[str] = D.PRODUCT_NK) -> DataFrame:
    """Close current rows of changed members: DVU = change date − 1 day, ``N``."""
    hit = changed.select(*key).withColumn("_chg", F.lit(True))
    j = dim.join(hit, key, "left")
    close = F.col("_chg").isNotNull() & (F.col("CurrentStatus") == S.STATUS_CURRENT)
    until = F.date_sub(F.lit(as_of.date()), 1)
    return (j.withColumn("DVU", F.when(close, until).otherwise(F.col("DVU")))
            .withColumn("CurrentStatus", F.when(close, F.lit(S.STATUS_EXPIRED)).otherwise(F.col("CurrentStatus")))
            .select(*dim.columns))


def expired_rows(dim: DataFrame, changed: DataFrame, as_of: _dt.datetime,
                 key: list[str] = D.PRODUCT_NK) -> DataFrame:
    """Only the rows that :func:`expire` closes, after closing."""
    cur = dim.filter(F.col("CurrentStatus") == S.STATUS_CURRENT).join(changed, key, "left_semi")
    return expire(cur, changed, as_of, key)


def versions_of(rows: DataFrame, changed: DataFrame, dim: DataFrame, as_of: _dt.datetime, key: list[str],
                order, key_col: str, flag_col: str, open_dvu: _dt.date = S.OPEN_DVU) -> DataFrame:
    """Generic new versions: source rows of the changed members, keyed above
    the dimension, stamped unloaded and opened as current from ``as_of``."""
    rows = rows.join(changed, key, "left_semi")
    keyed = assign_surrogate_keys(rows, order, key_col, max_key(dim, key_col))
    keyed = D.load_columns(keyed, flag_col, as_of, False)
    keyed = D.scd_columns(keyed, as_of.date(), open_dvu)
    return keyed.select(*dim.columns)


def new_versions(src: Sources, changed: DataFrame, dim: DataFrame, as_of: _dt.datetime,
                 open_dvu: _dt.date = S.OPEN_DVU) -> DataFrame:
    """New current rows for changed products, keyed above the dimension."""
    return versions_of(D.product_rows(src), changed, dim, as_of, D.PRODUCT_NK, D.PRODUCT_ORDER, "Product_Key",
                       "PDloaded", open_dvu)


def _fixed(changed: DataFrame) -> DataFrame:
    """The changed members, decided once: expiry and new versions must agree on
    them even if the source moves in between."""
    ensure_checkpoint_dir(changed.sparkSession)
    return changed.checkpoint(eager=True)


def price_comparison(rows: DataFrame, dim: DataFrame, ptype: str, prices: list[tuple[str, str]],
                     changed_only: bool = False) -> DataFrame:
    """Source prices beside those of the current dimension rows of one product
    type.  ``prices`` pairs the name of a source price in the result with the
    dimension's column; ``changed_only`` keeps rows in which any pair differs."""
    src = rows.select("ProductId", "Productname", *[F.col(dst).alias(name) for name, dst in prices])
    cur = (dim.filter((F.col("ProductType") == ptype) & (F.col("CurrentStatus") == S.STATUS_CURRENT))
           .select("ProductId", *[dst for _, dst in prices]))
    out = src.join(cur, "ProductId")
    if changed_only:
        differs = F.lit(False)
        for name, dst in prices:
            differs = differs | (F.col(name) != F.col(dst))
        out = out.filter(differs)
    return out


def apply_generic(rows: DataFrame, dim: DataFrame, as_of: _dt.datetime, key: list[str], tracked: list[str],
                  order, key_col: str, flag_col: str, open_dvu: _dt.date = S.OPEN_DVU) -> DataFrame:
    """One Type 2 round for any dimension (customers, stores): detect on the
    tracked columns, expire, add new versions."""
    changed = _fixed(detect(rows, dim, key, tracked))
    return expire(dim, changed, as_of, key).unionByName(
        versions_of(rows, changed, dim, as_of, key, order, key_col, flag_col, open_dvu))


def apply_changes(src: Sources, dim: DataFrame, as_of: _dt.datetime,
                  open_dvu: _dt.date = S.OPEN_DVU) -> DataFrame:
    """The dimension after one Type 2 round (staging form)."""
    changed = _fixed(detect_changes(src, dim))
    return expire(dim, changed, as_of).unionByName(new_versions(src, changed, dim, as_of, open_dvu))
