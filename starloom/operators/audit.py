"""Integrity audits: the constraints a parquet table cannot enforce (primary
keys, foreign keys, NOT NULL, declared lengths), as aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .facts import Dimensions
from .lookup import is_in_bitmap


def primary_key_audit(df: DataFrame, key: list[str]) -> DataFrame:
    """One row: rows, distinct keys, keys held by more than one row."""
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.sum("_n").cast("long").alias("NumRows"),
                       F.count(F.lit(1)).cast("long").alias("NumKeys"),
                       F.count(F.when(F.col("_n") > 1, F.lit(1))).cast("long").alias("DuplicatedKeys"))


def orphan_audit(fact: DataFrame, dims: Dimensions) -> DataFrame:
    """Fact rows whose foreign key has no dimension row, per dimension."""
    parts = []
    for name, key, dim in (("Customer_Dimension", "Customer_Key", dims.customer),
                           ("Store_Dimension", "Store_Key", dims.store),
                           ("Product_Dimension", "Product_Key", dims.product),
                           ("Calendar_Dimension", "Calendar_Key", dims.calendar)):
        # rows per key first (map-side combine: a hot key becomes one row per
        # partition before the shuffle), then the anti join on distinct keys
        per_key = fact.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        orphans = per_key.join(dim.select(key), key, "left_anti")
        parts.append(orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("OrphanRows"))
                     .select(F.lit(name).alias("Dimension"), "OrphanRows"))
    return reduce(DataFrame.unionByName, parts)


def load_orphan_audit(facts: DataFrame, dims: Dimensions) -> DataFrame:
    """:func:`orphan_audit` for the facts of one load, with bitmaps instead of
    joins on keys.  Surrogate keys are dense numbers, so a dimension's keys are
    exactly 4 KiB for each 32,768 of them; the load's keys, reduced map-side, are
    looked up there.  Earlier loads, audited when they came, aren't read."""
    parts = []
    for name, key, dim in (("Customer_Dimension", "Customer_Key", dims.customer), ("Store_Dimension", "Store_Key", dims.store),
                           ("Product_Dimension", "Product_Key", dims.product), ("Calendar_Dimension", "Calendar_Key", dims.calendar)):
        known = (dim.groupBy(F.bitmap_bucket_number(key).alias("_bucket"))
                 .agg(F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("_bits")))
        per_key = facts.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).withColumn("_bucket", F.bitmap_bucket_number(key))
        absent = per_key.join(known, "_bucket", "left").filter(F.col("_bits").isNull() | ~is_in_bitmap(F.col(key), F.col("_bits")))
        parts.append(absent.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("OrphanRows"))
                     .select(F.lit(name).alias("Dimension"), "OrphanRows"))
    return reduce(DataFrame.unionByName, parts)


def null_audit(tables: dict[str, DataFrame]) -> DataFrame:
    """NULL count of every column of every table (one pass per table)."""
    parts = []
    for name, df in tables.items():
        counts = df.agg(*[F.count(F.when(F.col(c).isNull(), F.lit(1))).cast("long").alias(c)
                          for c in df.columns])
        parts.append(counts.unpivot([], df.columns, "ColumnName", "NullCount")
                     .select(F.lit(name).alias("TableName"), "ColumnName", "NullCount"))
    return reduce(DataFrame.unionByName, parts)


def length_audit(tables: dict[str, DataFrame], limits: list[tuple[str, str, int]]) -> DataFrame:
    """Longest value and rows over the declared CHAR/VARCHAR length, one
    aggregate pass per table for all of its limited columns."""
    parts = []
    by_table: dict[str, list[tuple[str, int]]] = {}
    for table, column, n in limits:
        by_table.setdefault(table, []).append((column, n))
    for table, cols in by_table.items():
        aggs = []
        for i, (column, n) in enumerate(cols):
            ln = F.length(F.col(column))
            aggs += [F.coalesce(F.max(ln), F.lit(0)).cast("long").alias(f"m{i}"),
                     F.count(F.when(ln > n, F.lit(1))).cast("long").alias(f"o{i}")]
        row = tables[table].agg(*aggs)
        stack = ", ".join(f"'{c}', {n}L, m{i}, o{i}" for i, (c, n) in enumerate(cols))
        parts.append(row.selectExpr(f"stack({len(cols)}, {stack}) AS (ColumnName, LengthLimit, MaxLength, "
                                    f"RowsOverLimit)")
                     .select(F.lit(table).alias("TableName"), "ColumnName", "MaxLength", "LengthLimit",
                             "RowsOverLimit"))
    return reduce(DataFrame.unionByName, parts)
