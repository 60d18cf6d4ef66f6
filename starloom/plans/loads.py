"""Load compositions: what one run of each warehouse procedure computes.

Pure functions over DataFrames; :mod:`starloom.jobs` adds the reads and
repeatable writes around them."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import dims as D
from ..operators import facts as FX
from ..operators import load as L
from ..sources import Sources


def build_dimensions(src: Sources) -> FX.Dimensions:
    """Initial full load of the four dimensions.

    The three keyed builds are independent, so their jobs are submitted
    concurrently and share the cluster instead of running one after another."""
    with ThreadPoolExecutor(max_workers=3) as pool:
        cust = pool.submit(D.customer_dimension, src)
        store = pool.submit(D.store_dimension, src)
        prod = pool.submit(D.product_dimension, src)
        return FX.Dimensions(customer=cust.result(), store=store.result(), product=prod.result(),
                             calendar=D.calendar_dimension(src))


def initial_fact_load(src: Sources, dims: FX.Dimensions, as_of: _dt.datetime,
                      keep: Callable[[DataFrame], DataFrame] = FX.unkept) -> DataFrame:
    """Every transaction line, no bound; stamped ``as_of`` and flagged loaded
    (the back-fill that precedes the first refresh).  ``keep`` may write the
    extracted lines (see :func:`facts.intermediate_fact`)."""
    ds = FX.resolve_fact_keys(FX.intermediate_fact(src, keep=keep), dims, as_of)
    return L.mark_loaded(ds, "f_loaded")


def recent_facts(fact: DataFrame, calendar: DataFrame, mark) -> DataFrame:
    """Fact rows dated after the mark.  Only these can share a transaction
    with a line extracted above the mark, so the re-extraction guard reads
    recent history only (a partition-pruned read on a date-partitioned fact)."""
    keys = calendar.filter(F.col("FullDate") > mark).select("Calendar_Key")
    return fact.join(keys, "Calendar_Key", "left_semi")


def daily_lines(src: Sources, dims: FX.Dimensions, fact: DataFrame, mark) -> DataFrame:
    """Lines dated after the high-water mark that the fact does not hold, so a
    rerun or a future-dated transaction adds nothing twice."""
    inter = FX.intermediate_fact(src, mark, bounded=True)
    return FX.not_yet_loaded(inter, recent_facts(fact, dims.calendar, mark), dims.product)


def daily_refresh(src: Sources, dims: FX.Dimensions, fact: DataFrame, as_of: _dt.datetime,
                  mark=None) -> DataFrame:
    """Staging rows of one daily refresh, before publishing (flag false): the
    new lines, keyed and stamped.  ``mark`` may be passed when the caller knows
    the high-water mark of ``fact`` (e.g. from a load log)."""
    if mark is None:
        mark = FX.high_water_mark(fact).scalar()
    return FX.resolve_fact_keys(daily_lines(src, dims, fact, mark), dims, as_of)


def late_fact_refresh(src: Sources, dims: FX.Dimensions, fact: DataFrame | None, as_of: _dt.datetime,
                      sales_tids: DataFrame | None = None, rental_tids: DataFrame | None = None) -> DataFrame:
    """Staging rows of late-arriving transactions (no fact of their kind yet)."""
    return FX.resolve_fact_keys(FX.late_facts(src, fact, sales_tids, rental_tids), dims, as_of)
