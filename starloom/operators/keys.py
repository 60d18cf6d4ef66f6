"""Surrogate keys (auto-increment) assigned in natural-key order, distributed.

A global ``row_number() OVER (ORDER BY nk)`` moves every row into one task.
Instead the rows are range-partitioned and sorted on the natural key, written
to the reliable checkpoint directory (so that both passes below see the same
partitions even if an executor is lost and a stage recomputes), and each row
gets ``base + (rows in earlier partitions) + (position in its partition)``.
The per-partition counts are one number per partition: they are collected
and applied as a constant, bounded by the partition count, not by the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_ROW_BITS = (1 << 33) - 1  # monotonically_increasing_id keeps the row number in the low 33 bits


def max_key(dim: DataFrame, key_col: str) -> Column:
    """Scalar subquery: the largest key in use, 0 for an empty dimension."""
    return dim.agg(F.coalesce(F.max(key_col), F.lit(0)).cast("long")).scalar()


def sort_columns(order) -> list[Column]:
    """``[(name, ascending), …]`` or Columns → sort Columns."""
    out = []
    for o in order:
        if isinstance(o, Column):
            out.append(o)
        else:
            name, asc = o
            out.append(F.col(name).asc() if asc else F.col(name).desc())
    return out


def assign_surrogate_keys(df: DataFrame, order, key_col: str,
                          base: Column | int = 0, num_partitions: int | None = None) -> DataFrame:
    """Add ``key_col`` = ``base`` + 1-based rank of each row in ``order``.

    ``order`` must be a total order over the rows (a unique natural key), so
    that the result equals ``base + row_number() OVER (ORDER BY order)``.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    order = sort_columns(order)
    # Without an explicit count AQE may merge adjacent ranges into partitions
    # of the advisory size; merged ranges stay contiguous, so the order holds.
    ranged = (df.repartitionByRange(num_partitions, *order) if num_partitions
              else df.repartitionByRange(*order))
    ranged = ranged.sortWithinPartitions(*order).checkpoint(eager=True)
    # one row per partition: the only thing that reaches the driver
    counts = dict(ranged.groupBy(F.spark_partition_id().alias("pid")).count().collect())
    offsets, run = [], 0
    for pid in range(max(counts) + 1 if counts else 0):
        offsets.append(run)
        run += counts.get(pid, 0)
    base_col = base if isinstance(base, Column) else F.lit(base)
    if not offsets:
        return ranged.withColumn(key_col, F.lit(None).cast("long")).limit(0)
    # a constant array (folded into one literal): no join, so the keyed
    # table keeps the size estimate of its input and broadcasts when small
    offset = F.element_at(F.array(*[F.lit(o) for o in offsets]), F.spark_partition_id() + 1)
    pos = F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS))
    return ranged.withColumn(key_col, (base_col + offset + pos + 1).cast("long"))
