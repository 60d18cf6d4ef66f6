"""Cutting a long job into steps."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.session import ensure_checkpoint_dir


def settle(df: DataFrame) -> DataFrame:
    """The rows of ``df`` from the shared checkpoint folder.  What the step left
    behind (shuffle files, checkpoints that nothing refers to any more) goes when
    the driver collects its garbage, so it is asked to: a job of many steps then
    needs the disk of its largest step, not of all."""
    ensure_checkpoint_dir(df.sparkSession)
    out = df.checkpoint()
    release(df.sparkSession)
    return out


def release(spark: SparkSession) -> None:
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: Bits of the bitmaps that ids are looked up in: 128 KiB, whatever the input.
ID_BITS = 1 << 20


def marked_among(rows: DataFrame, ids: DataFrame, column: str, mark: str) -> DataFrame:
    """Adds ``mark``: true for all rows whose ``column`` is among ``ids``, and
    for some others by chance.  A bitmap of fixed size is looked up with a
    broadcast join (of 2**14 rows at most); it spares a later join most of the
    rows it would shuffle for nothing, and decides nothing itself."""
    place = F.pmod(F.xxhash64(column), F.lit(ID_BITS))
    word, bit = F.shiftright(place, 6).cast("int"), place.bitwiseAND(63).cast("int")
    bitmap = (ids.select(word.alias("__word"), bit.alias("b")).groupBy("__word").agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias("__bits")))
    return (rows.join(F.broadcast(bitmap), word == F.col("__word"), "left")
            .withColumn(mark, F.coalesce(F.getbit("__bits", bit) == 1, F.lit(False))).drop("__word", "__bits"))


def maybe_among(rows: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """The rows that :func:`marked_among` marks."""
    return marked_among(rows, ids, column, "__among").where("__among").drop("__among")


_held: dict[str, Callable[[], None]] = {}


def holds(owner: str, forget: Callable[[], None] = lambda: None) -> None:
    """To be called where a task of an operator begins.  The same Python workers
    run all of a job's steps: what other operators keep in the worker between
    tasks is freed (``forget`` frees what this one keeps), and memory that the
    last task has freed is handed back to the system."""
    others = [o for o in _held if o != owner]
    for o in others:
        _held.pop(o)()
    _held[owner] = forget
    if others:
        gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library
