"""The warehouse state of the fixture scenario, built lazily from the tables.

Timeline (all clocks from :class:`starloom.config.Params`):

* ``dims_loaded_at``: dimensions loaded from the operational master data;
* ``scd_as_of``: source product edits, one Type 2 round;
* ``initial_as_of``: initial fact load of the base orders;
* ``refresh_as_of``: daily fact refresh, late-fact refresh and dimension
  refreshes.

Each attribute is a DataFrame; nothing runs until an action, except the
surrogate-key checkpoints inside dimension builds.
"""

from __future__ import annotations

import contextlib
import dataclasses
import functools
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..config import DEFAULT, Params
from ..operators import dims as D
from ..operators import facts as FX
from ..operators import load as L
from ..operators import scd2
from ..session import ensure_checkpoint_dir
from ..sources import Sources, fixture_sources
from . import loads


def _number(id_col: str) -> Column:
    """The number in a fixture id (a letter and digits)."""
    return F.substring(id_col, 2, 20).cast("long")


#: Spark removes the shuffle files of an action when it ends, on all executors,
#: instead of when the driver's garbage collector happens to find them unused.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession):
    """Actions within leave no shuffle files behind."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str, params: Params = DEFAULT):
        self.spark, self.sf_dir, self.p = spark, sf_dir, params
        self._prior: dict[str, DataFrame] = {}

    def stored(self, df: DataFrame) -> DataFrame:
        """A state table as the next load reads it: written to the reliable
        checkpoint directory, so later steps read it instead of recomputing
        its lineage (and a lost executor does not recompute it either)."""
        ensure_checkpoint_dir(self.spark)
        return df.checkpoint(eager=True)

    def table(self, df: DataFrame) -> DataFrame:
        """The same for a large state of which later steps read some columns:
        written as Parquet below that directory.  The shuffle files of the step
        go when it is written, so disk holds one step's and not all steps'."""
        path = f"{ensure_checkpoint_dir(self.spark)}/table-{uuid.uuid4().hex}"
        with shuffles_removed(self.spark):
            df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    # ---- sources -------------------------------------------------------
    @functools.cached_property
    def src(self) -> Sources:
        """The operational system at the refresh (every order present)."""
        return fixture_sources(self.spark, self.sf_dir, self.p, "full")

    @functools.cached_property
    def base_src(self) -> Sources:
        """The operational system at the initial fact load."""
        return fixture_sources(self.spark, self.sf_dir, self.p, "base")

    @functools.cached_property
    def changed_src(self) -> Sources:
        """The operational system after the scenario's product edits."""
        return fixture_sources(self.spark, self.sf_dir, self.p, "full", changed=True)

    @functools.cached_property
    def master_at_start(self) -> Sources:
        """Master data when the refreshed dimensions were loaded: customers,
        stores and listed products referenced by orders dated up to
        ``master_cutoff``; the rest registers later (or has no order yet)."""
        s, cut = self.src, F.lit(self.p.master_cutoff)
        st = s.salestransaction.filter(F.col("tdate") <= cut)
        rt = s.rentaltransaction.filter(F.col("tdate") <= cut)
        tx = st.select("customerid", "storeid").unionByName(rt.select("customerid", "storeid"))
        sold = s.soldvia.join(st.select("tid"), "tid", "left_semi").select("productid")
        rented = s.rentvia.join(rt.select("tid"), "tid", "left_semi").select("productid")
        return s.replace(
            customer=s.customer.join(tx.select("customerid"), "customerid", "left_semi"),
            store=(s.store.join(tx.select("storeid"), "storeid", "left_semi")
                   .filter(_number("storeid") % self.p.held_store_every != 0)),
            product=s.product.join(sold, "productid", "left_semi"),
            rentalproducts=s.rentalproducts.join(rented, "productid", "left_semi"))

    # ---- dimensions ----------------------------------------------------
    @functools.cached_property
    def dims(self) -> FX.Dimensions:
        """The stores are read from a table of theirs: they come from joins, whose
        size Spark takes for the product of the tables', and all lines would be
        shuffled to look up a dimension that is small enough to be broadcast."""
        d = loads.build_dimensions(self.src)
        return dataclasses.replace(d, store=self.table(d.store))

    def staged(self, dim: DataFrame, flag_col: str, loaded_at=None) -> DataFrame:
        """A dimension as staged at ``loaded_at`` (default ``dims_loaded_at``):
        stamped, published, and opened as current Type 2 rows."""
        stamp = loaded_at or self.p.dims_loaded_at
        return scd2.initialise(D.load_columns(dim, flag_col, stamp, True), self.p.open_dvf, self.p.open_dvu)

    @functools.cached_property
    def product_ds(self) -> DataFrame:
        return self.staged(self.dims.product, "PDloaded")

    # ---- facts ---------------------------------------------------------
    @functools.cached_property
    def initial_fact(self) -> DataFrame:
        """Initial load: every base order, no bound; stamped, then flagged
        loaded (the back-fill that precedes the first refresh)."""
        return self.table(loads.initial_fact_load(self.base_src, self.dims, self.p.initial_as_of, self.table))

    @functools.cached_property
    def full_initial_fact(self) -> DataFrame:
        """An initial load on the day of the refresh: every order there is."""
        return loads.initial_fact_load(self.src, self.dims, self.p.refresh_as_of)

    @functools.cached_property
    def mark(self):
        """Scalar subquery: the high-water mark of the initial fact."""
        return FX.high_water_mark(self.initial_fact).scalar()

    @functools.cached_property
    def daily_inter(self) -> DataFrame:
        return FX.intermediate_fact(self.src, self.mark, bounded=True)

    @functools.cached_property
    def daily_new(self) -> DataFrame:
        """DS rows the daily refresh appends (flag still false)."""
        return loads.daily_refresh(self.src, self.dims, self.initial_fact, self.p.refresh_as_of, self.mark)

    @functools.cached_property
    def after_daily(self) -> DataFrame:
        """The staging fact after the daily refresh, which wrote its rows: the
        steps after it look at them several times."""
        return self.initial_fact.unionByName(L.mark_loaded(self.table(self.daily_new), "f_loaded"))

    @functools.cached_property
    def late_inter(self) -> DataFrame:
        return FX.late_facts(self.src, self.after_daily)

    @functools.cached_property
    def late_new(self) -> DataFrame:
        return loads.late_fact_refresh(self.src, self.dims, self.after_daily, self.p.refresh_as_of)

    @functools.cached_property
    def fact(self) -> DataFrame:
        """The published fact after the loads, for the marts.  It equals one
        full load of every order (checked by the tests), which is how it is
        computed: one extraction instead of three."""
        return FX.resolve_fact_keys(FX.intermediate_fact(self.src), self.dims, self.p.refresh_as_of)

    @functools.cached_property
    def published_fact(self) -> DataFrame:
        """:attr:`fact` as a table in the checkpoint directory, for marts that
        read it more than once: one extraction, and each read takes only the
        columns it needs."""
        return self.table(self.fact.select(*S.FACT_DW_COLS))

    def planted_fact(self) -> DataFrame:
        """The loaded fact with the lines of some products twice."""
        f = self.after_daily.unionByName(L.mark_loaded(self.table(self.late_new), "f_loaded"))
        return f.unionByName(f.filter(F.col("Product_Key") % self.p.planted_duplicate_every == 0))

    def hot_customer_lines(self) -> DataFrame:
        """All lines, every second transaction given to one customer."""
        lines = FX.intermediate_fact(self.src)
        return lines.withColumn("CustomerId", F.when(_number("TID") % 2 == 0, F.lit(self.p.hot_customer)).otherwise(F.col("CustomerId")))

    def short_dims(self) -> FX.Dimensions:
        """The dimensions without some of their keys."""
        d, n = self.dims, self.p.planted_orphan_every
        return FX.Dimensions(customer=d.customer.filter(F.col("Customer_Key") % n != 0), store=d.store.filter(F.col("Store_Key") % n != 0),
                             product=d.product.filter(F.col("Product_Key") % n != 0), calendar=d.calendar.filter(F.col("Calendar_Key") % n != 0))

    # ---- Type 2 scenario -----------------------------------------------
    @functools.cached_property
    def changed_products(self) -> DataFrame:
        return scd2.detect_changes(self.changed_src, self.product_ds)

    @functools.cached_property
    def product_after_scd(self) -> DataFrame:
        return scd2.apply_changes(self.changed_src, self.product_ds, self.p.scd_as_of, self.p.open_dvu)

    def dims_after_scd(self) -> FX.Dimensions:
        d = self.dims
        return FX.Dimensions(customer=d.customer, store=d.store, product=self.product_after_scd,
                             calendar=d.calendar)

    # ---- dimension refresh scenario --------------------------------------
    def prior_dim(self, name: str) -> DataFrame:
        """One dimension as loaded at ``master_loaded_at`` (built on demand)."""
        if name not in self._prior:
            m, at = self.master_at_start, self.p.master_loaded_at
            if name == "product":  # the lines' shuffles go before keys are assigned
                m = m.replace(product=self.table(m.product), rentalproducts=self.table(m.rentalproducts))
            build, flag = {"customer": (D.customer_dimension, "Cloaded"),
                           "store": (D.store_dimension, "Sloaded"),
                           "product": (D.product_dimension, "PDloaded")}[name]
            self._prior[name] = self.staged(build(m), flag, at)
        return self._prior[name]
