"""Jobs: the warehouse procedures as repeatable Spark writes.

Layout under ``root`` (any Hadoop file system):

* ``ds|dw/revenue_fact/load_id=<id>/fact_year=…/fact_month=…/`` — one
  directory per load, replaced whole when the load is rerun, so a failure
  between any two writes is healed by rerunning the same load;
* ``ds|dw/<dimension>/snapshot=<n>/`` — dimension versions; a job that changes
  rows reads the latest complete snapshot and writes the next one (a path is never
  overwritten while it is read), a job that only adds rows writes them as a part
  of the snapshot, ``parts-of=<n>/part=<k>/``.  DS is written first and fixes the
  keys; DW is then brought in line with DS, which also repairs an earlier
  unfinished run;
* ``_keys/<dimension>/from=<first>`` — the blocks of keys that jobs have reserved;
* ``_loads/load_id=<id>/`` — one row per fact load (kind, as_of, rows, place in
  the sequence of loads), written last: facts of a load without its row are not
  read; the high-water mark is read from it without scanning the fact;
* ``ds/loaded_tids-<buckets>/load_id=<id>/`` — the distinct transaction ids of
  each load and their kind, bucketed by ``tid``: the late-fact anti join reads
  it without shuffling (only the source side is shuffled to the buckets);
* ``ds/unresolved/load_id=<id>/`` — after this load, the lines that have not
  found all their keys, with the reason; the next load tries them again;
* ``marts/daily_store_snapshot/fact_year=…/fact_month=…/`` — the snapshot, of
  which only the months that new loads touch are written again, and in
  ``marts/daily_store_snapshot_state-<parameters>/batch=<n>/`` what each batch of
  loads adds to its additive form;
* ``marts/…`` — the roll-up marts, and the results of the marts' audits.

Each load's state excludes its own ``load_id``; only the latest load of the
sequence may be rerun, as later loads build on it, and a load that has begun to
write must be finished before another one starts."""

from __future__ import annotations

import datetime as _dt
import hashlib
import os
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schema as S
from .config import DEFAULT, Params
from .operators import audit as A
from .operators import dims as D
from .operators import facts as FX
from .operators import load as L
from .operators import lookup
from .operators import marts as M
from .operators import scd2
from .plans import loads
from .sources import Sources

FACT_SCHEMA = ("RevenueGenerated decimal(18,2), UnitSolds int, RevenueType string, TID string, "
               "Customer_Key long, Store_Key long, Product_Key long, Calendar_Key long")
DS_FACT_SCHEMA = FACT_SCHEMA + ", ExtractionTimestamp timestamp_ntz, f_loaded boolean"
LOG_SCHEMA = "kind string, as_of timestamp_ntz, num_rows long, seq long"
_HISTORY_SCHEMA = "DVF date, DVU date, CurrentStatus string"
DIM_SCHEMAS = {
    "customer": "Customer_Key long, CustomerID string, CustomerName string, CustomerZip string",
    "store": "Store_Key long, StoreID string, StoreZip string, RegionID string, RegionName string",
    "product": "Product_Key long, ProductId string, Productname string, VendorId string, Vendorname string, CategoryID string, "
               "Categoryname string, ProductSalesPrice decimal(7,2), ProductDailyRentalPrice decimal(7,2), "
               "ProductWeeklyRental decimal(7,2), ProductType string",
    "calendar": "Calendar_Key long, FullDate date, CalendarMonth int, CalendarYear int"}
STATE_SCHEMA = ("Calendar_Key long, Store_Key long, Units long, Revenue decimal(18,2), Lines long, Transactions long, "
                "Tracked decimal(18,2), HighValue long, Local decimal(18,2), batch long, fact_year int, fact_month int")
UNRESOLVED_SCHEMA = ("UnitSolds int, RevenueGenerated decimal(18,2), RevenueType string, TID string, ProductId string, "
                     "CustomerId string, StoreId string, FullDate date, Reason string")
DIMENSIONS = {"customer": ("Customer_Dimension", "Cloaded", "Customer_Key", S.CUSTOMER_DW_COLS),
              "store": ("Store_Dimension", "Sloaded", "Store_Key", S.STORE_DW_COLS),
              "product": ("Product_Dimension", "PDloaded", "Product_Key", S.PRODUCT_DW_COLS)}


class Store:
    """Paths and reads of one warehouse root."""

    def __init__(self, spark: SparkSession, root: str, tid_buckets: int = DEFAULT.tid_buckets):
        self.spark, self.root, self._tid_buckets = spark, root.rstrip("/"), tid_buckets
        jvm = spark.sparkContext._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _fs(self, path: str):
        return self._Path(path).getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        return self._fs(path).exists(self._Path(path))

    def _children(self, path: str, prefix: str) -> list[str]:
        if not self.exists(path):
            return []
        return [s.getPath().getName()[len(prefix):] for s in self._fs(path).listStatus(self._Path(path))
                if s.isDirectory() and s.getPath().getName().startswith(prefix)]

    # ---- facts and the load log ------------------------------------------
    def fact_path(self, layer: str) -> str:
        return f"{self.root}/{layer}/revenue_fact"

    def read_fact(self, layer: str, exclude_load: str | None = None, keep_partitions: bool = False,
                  only: list[str] | None = None, months: list[tuple[int, int]] | None = None) -> DataFrame:
        """Facts of the finished loads (of those named in ``only``), or of some
        months; what is asked for is pruned to directories."""
        path = self.fact_path(layer)
        schema = DS_FACT_SCHEMA if layer == "ds" else FACT_SCHEMA
        cols = [c.split(" ")[0] for c in schema.split(", ")]
        loads_ = [i for i in (self.load_ids() if only is None else only) if i != exclude_load]
        if not loads_ or not self._children(path, "load_id="):
            empty = self.spark.createDataFrame([], schema)
            return empty.selectExpr("*", "CAST(NULL AS INT) AS fact_year", "CAST(NULL AS INT) AS fact_month") if keep_partitions else empty
        # the declared schema: a load without rows leaves a directory without files
        df = self.spark.read.schema(f"{schema}, load_id string, fact_year int, fact_month int").parquet(path)
        df = df.filter(F.col("load_id").isin(loads_))
        if months is not None:
            df = df.filter((F.col("fact_year") * 12 + F.col("fact_month")).isin([y * 12 + m for y, m in months]))
        return df.select(*cols, "fact_year", "fact_month") if keep_partitions else df.select(*cols)

    def load_months(self, layer: str, load_id: str) -> list[tuple[int, int]]:
        """Years and months of a load's directories."""
        return self._months(f"{self.fact_path(layer)}/load_id={load_id}")

    def _months(self, path: str) -> list[tuple[int, int]]:
        return [(int(y), int(m)) for y in self._children(path, "fact_year=") for m in self._children(f"{path}/fact_year={y}", "fact_month=")]

    def write_fact(self, layer: str, load_id: str, df: DataFrame, calendar: DataFrame | None = None) -> None:
        """Replace the load's directory, partitioned by year and month of the
        transaction date (the calendar is one row per day: a bounded broadcast;
        not needed where ``df`` has them).  Rows are gathered by month first, so a
        month is a few large files; the rebalance splits months that are too large
        for one task."""
        if calendar is not None:
            ym = calendar.select("Calendar_Key", F.col("CalendarYear").alias("fact_year"), F.col("CalendarMonth").alias("fact_month"))
            df = df.join(F.broadcast(ym), "Calendar_Key").select(*df.columns, "fact_year", "fact_month")
        (df.hint("rebalance", "fact_year", "fact_month").write.mode("overwrite").partitionBy("fact_year", "fact_month")
         .parquet(f"{self.fact_path(layer)}/load_id={load_id}"))

    def written_load(self, load_id: str) -> DataFrame:
        """The staged facts of a load that is being written."""
        return (self.spark.read.schema(f"{DS_FACT_SCHEMA}, fact_year int, fact_month int")
                .parquet(f"{self.fact_path('ds')}/load_id={load_id}"))

    def load_ids(self) -> list[str]:
        """Finished loads: those with a row in the log (a job that died while
        writing it leaves a directory without rows)."""
        return sorted(r[0] for r in self.read_log().select("load_id").collect())

    def read_log(self, exclude_load: str | None = None) -> DataFrame:
        if not self._children(f"{self.root}/_loads", "load_id="):
            return self.spark.createDataFrame([], LOG_SCHEMA + ", load_id string")
        df = self.spark.read.schema(LOG_SCHEMA + ", load_id string").parquet(f"{self.root}/_loads")
        return df if exclude_load is None else df.filter(F.col("load_id") != exclude_load)

    def write_log(self, load_id: str, kind: str, as_of: _dt.datetime, num_rows: int, seq: int) -> None:
        (self.spark.createDataFrame([(kind, as_of, num_rows, seq)], LOG_SCHEMA).coalesce(1)
         .write.mode("overwrite").parquet(f"{self.root}/_loads/load_id={load_id}"))

    def mark(self, exclude_load: str | None = None):
        """High-water mark: latest date of a load that wrote fact rows."""
        log = self.read_log(exclude_load).filter(F.col("num_rows") > 0)
        return log.agg(F.max(F.to_date("as_of"))).first()[0]

    def place(self, load_id: str) -> int:
        """The load's place in the sequence of loads: its own if it is the last
        one, run again, else the next.  Refused for an earlier load, and while
        another load has written facts without having been finished."""
        order = {r["load_id"]: r["seq"] for r in self.read_log().select("load_id", "seq").collect()}
        begun = {i for layer in ("ds", "dw") for i in self._children(self.fact_path(layer), "load_id=")}
        open_loads = sorted(begun - {*order} - {load_id})
        if open_loads:
            raise RuntimeError(f"unfinished loads must be run again first: {', '.join(open_loads)}")
        last = max(order.values(), default=0)
        if order.get(load_id, last) < last:
            raise RuntimeError(f"load {load_id} is not the latest; later loads build on it")
        return order.get(load_id, last + 1)

    def previous(self, load_id: str) -> str | None:
        """The load before this one in the sequence."""
        row = self.read_log(load_id).orderBy(F.desc("seq")).select("load_id").first()
        return row and row[0]

    # ---- lines without keys -------------------------------------------------
    def read_unresolved(self, load_id: str | None) -> DataFrame:
        """The lines left without keys after the load (none for no load)."""
        path = f"{self.root}/ds/unresolved/load_id={load_id}"
        if load_id is None or not self.exists(path):
            return self.spark.createDataFrame([], UNRESOLVED_SCHEMA)
        return self.spark.read.schema(UNRESOLVED_SCHEMA).parquet(path)

    def write_unresolved(self, load_id: str, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(f"{self.root}/ds/unresolved/load_id={load_id}")

    # ---- loaded-TID index (bucketed by tid) ---------------------------------
    def tid_index(self) -> str:
        """Name of the session table over the index.  The table is external:
        declaring it again in a new session finds the same files."""
        if not getattr(self, "_tid_index_ready", None):
            # the number of buckets is that of the index as it was last written
            made = [int(n) for n in self._children(f"{self.root}/ds", "loaded_tids-")]
            self._tid_buckets = max(made, default=self._tid_buckets)
            self._tid_index_ready = self._tid_table(self._tid_buckets, f"{self.root}/ds/loaded_tids-{self._tid_buckets}")
        return self._tid_index_ready

    def _tid_table(self, buckets: int, loc: str) -> str:
        name = "starloom_tids_" + hashlib.sha1(loc.encode()).hexdigest()[:12]
        self._fs(loc).mkdirs(self._Path(loc))
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (tid STRING, kind STRING, load_id STRING) USING parquet "
                       f"PARTITIONED BY (load_id) CLUSTERED BY (tid) INTO {buckets} BUCKETS LOCATION '{loc}'")
        self.spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        return name

    def write_tid_index(self, load_id: str, facts: DataFrame) -> None:
        """Replace the load's slice of the index (static partition overwrite),
        one task and one file a bucket, and its summary: the smallest and largest
        id of each kind."""
        index = self.tid_index()
        tids = facts.select(F.col("TID").alias("tid"),
                            F.when(F.col("RevenueType") == S.SALES, F.lit("S")).otherwise(F.lit("R")).alias("kind")).distinct()
        self._insert_tids(index, self._tid_buckets, load_id, tids)
        (self.spark.table(index).filter(F.col("load_id") == load_id).groupBy("kind").agg(F.min("tid").alias("low"), F.max("tid").alias("high"))
         .coalesce(1).write.mode("overwrite").parquet(f"{self.root}/ds/tid_ranges/load_id={load_id}"))

    def _insert_tids(self, index: str, buckets: int, load_id: str, tids: DataFrame) -> None:
        view = "starloom_tids_" + hashlib.sha1(load_id.encode()).hexdigest()[:12]
        tids.repartition(buckets, "tid").createOrReplaceTempView(view)
        self.spark.sql(f"INSERT OVERWRITE TABLE {index} PARTITION (load_id='{load_id}') SELECT tid, kind FROM {view}")
        self.spark.catalog.dropTempView(view)

    def loaded_tids(self, kind: str, exclude_load: str | None = None, within: tuple[str, str] | None = None) -> DataFrame:
        """Loaded ids of a kind.  ``within`` are the smallest and largest id that
        matter: loads whose ids all lie outside aren't read."""
        idx = self.spark.table(self.tid_index()).filter(F.col("kind") == kind)
        if exclude_load is not None:
            idx = idx.filter(F.col("load_id") != exclude_load)
        if within is not None and self.exists(f"{self.root}/ds/tid_ranges"):
            ranges = self.spark.read.schema("kind string, low string, high string, load_id string").parquet(f"{self.root}/ds/tid_ranges")
            idx = idx.filter(F.col("load_id").isin([r[0] for r in ranges.filter(
                (F.col("kind") == kind) & (F.col("low") <= within[1]) & (F.col("high") >= within[0])).select("load_id").collect()]))
        return idx.select("tid")

    def grow_tid_index(self, buckets: int) -> None:
        """Write the index with more buckets, load by load, beside the present one,
        which is read until the new one is whole and removed after."""
        old, n = self.tid_index(), self._tid_buckets
        if buckets <= n:
            raise ValueError(f"the index has {n} buckets already")
        making, made = f"{self.root}/ds/growing_tids-{buckets}", f"{self.root}/ds/loaded_tids-{buckets}"
        self.remove(making)
        new = self._tid_table(buckets, making)
        for load_id in sorted(self._children(f"{self.root}/ds/loaded_tids-{n}", "load_id=")):
            self._insert_tids(new, buckets, load_id, self.spark.table(old).filter(F.col("load_id") == load_id).select("tid", "kind"))
        self._fs(making).rename(self._Path(making), self._Path(made))
        for table in (old, new):
            self.spark.sql(f"DROP TABLE {table}")
        self.remove(f"{self.root}/ds/loaded_tids-{n}")
        self._tid_index_ready = None

    # ---- dimensions ---------------------------------------------------------
    def dim_path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def latest_snapshot(self, layer: str, name: str) -> int | None:
        done = [int(n) for n in self._children(self.dim_path(layer, name), "snapshot=")
                if self.exists(f"{self.dim_path(layer, name)}/snapshot={n}/_SUCCESS")]
        return max(done) if done else None

    def _parts(self, layer: str, name: str, snapshot: int) -> list[int]:
        at = f"{self.dim_path(layer, name)}/parts-of={snapshot}"
        return sorted(int(k) for k in self._children(at, "part=") if self.exists(f"{at}/part={k}/_SUCCESS"))

    def read_dim(self, layer: str, name: str) -> DataFrame:
        """The latest snapshot with the parts added to it, in the declared schema."""
        n = self.latest_snapshot(layer, name)
        if n is None:
            raise FileNotFoundError(f"no snapshot of {layer}/{name}")
        schema = DIM_SCHEMAS[name]
        if name in DIMENSIONS:
            loaded = f", ExtractionTimestamp timestamp_ntz, {DIMENSIONS[name][1]} boolean" if layer == "ds" else ""
            schema += f"{loaded}, {_HISTORY_SCHEMA}"
        at = self.dim_path(layer, name)
        return self.spark.read.schema(schema).parquet(f"{at}/snapshot={n}", *[f"{at}/parts-of={n}/part={k}" for k in self._parts(layer, name, n)])

    def write_dim(self, layer: str, name: str, df: DataFrame, snapshot: int | None = None) -> int:
        """The next snapshot (or the given one, for a load that starts anew)."""
        n = self.latest_snapshot(layer, name)
        nxt = snapshot if snapshot is not None else 0 if n is None else n + 1
        df.write.mode("overwrite").parquet(f"{self.dim_path(layer, name)}/snapshot={nxt}")
        return nxt

    def append_dim(self, layer: str, name: str, df: DataFrame) -> int:
        """Rows added to the latest snapshot, as a part beside it."""
        n = self.latest_snapshot(layer, name)
        part = max(self._parts(layer, name, n), default=-1) + 1
        df.hint("rebalance").write.mode("overwrite").parquet(f"{self.dim_path(layer, name)}/parts-of={n}/part={part}")
        return part

    def has_later_snapshots(self) -> bool:
        """Whether a dimension has changed since the initial load."""
        for layer in ("ds", "dw"):
            for name in (*DIMENSIONS, "calendar"):
                n = self.latest_snapshot(layer, name)
                if n is not None and (n > 0 or self._parts(layer, name, n)):
                    return True
        return False

    # ---- blocks of keys -----------------------------------------------------
    def reserve_keys(self, name: str, size: int, floor: int, job: str) -> int:
        """First key of a block of ``size`` keys that nobody else gets, above
        ``floor`` (the largest key in use) and above all blocks reserved before.
        A block is a file named by its first key; making a file that must not
        exist yet decides between jobs that want the same one.  A job that runs
        again gets the block it has, if that is as large."""
        at = f"{self.root}/_keys/{name}"
        while True:
            first = floor + 1
            for start in sorted(int(c) for c in self._files(at, "from=")):
                n, owner = self._block(f"{at}/from={start}")
                if owner == job and n == size and start > floor:
                    return start
                first = max(first, start + n)
            if self._claim(f"{at}/from={first}", f"{size} {job}\n"):
                return first

    def _claim(self, path: str, text: str) -> bool:
        """Make a file that must not exist yet; false if another job was faster.
        The store decides between them (on a mounted folder a hard link does, as
        Hadoop's local file system would overwrite)."""
        fs = self._fs(path)
        if fs.getUri().getScheme() == "file":
            path = path.removeprefix("file://")
            own = f"{os.path.dirname(path)}/claim-{uuid.uuid4().hex}"
            os.makedirs(os.path.dirname(path), exist_ok=True)
            with open(own, "w") as f:
                f.write(text)
            try:
                os.link(own, path)
                return True
            except FileExistsError:
                return False
            finally:
                os.unlink(own)
        try:
            out = fs.create(self._Path(path), False)
        except Exception as e:
            if not fs.exists(self._Path(path)):
                raise e
            return False
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def _files(self, path: str, prefix: str) -> list[str]:
        if not self.exists(path):
            return []
        return [s.getPath().getName()[len(prefix):] for s in self._fs(path).listStatus(self._Path(path)) if s.getPath().getName().startswith(prefix)]

    def _block(self, path: str, patience: float = 10.0) -> tuple[int, str]:
        """Size and owner of a block; its file may be about to be written."""
        until = time.time() + patience
        while True:
            row = self.spark.read.text(path).first()
            if row:
                size, owner = row[0].split(" ", 1)
                return int(size), owner
            if time.time() > until:
                raise RuntimeError(f"{path} names a block of keys without its size: remove it if no job is writing it")
            time.sleep(0.2)

    # ---- the snapshot's state -------------------------------------------------
    def state_path(self, params: Params) -> str:
        """The state depends on the parameters of the measures, so these name it."""
        name = hashlib.sha1(f"{params.tracked_category}|{params.high_value}|{params.zip_prefix}".encode()).hexdigest()[:8]
        return f"{self.root}/marts/daily_store_snapshot_state-{name}"

    def batches(self, state: str) -> dict[int, list[str]]:
        """Finished batches of the state and the loads in them."""
        noted = [n for n in self._children(f"{state}/log", "batch=") if self.exists(f"{state}/log/batch={n}/_SUCCESS")]
        return {int(n): [r[0] for r in self.spark.read.schema("load_id string").parquet(f"{state}/log/batch={n}").collect()] for n in noted}

    def remove(self, path: str) -> None:
        self._fs(path).delete(self._Path(path), True)

    def forget_in_marts(self, load_id: str) -> None:
        """Before a load is written (again): the snapshots take back what they
        hold of it, so that the next snapshot job counts it anew."""
        for state in self._children(f"{self.root}/marts", "daily_store_snapshot_state-"):
            state = f"{self.root}/marts/daily_store_snapshot_state-{state}"
            for n, members in self.batches(state).items():
                if load_id in members:
                    self.remove(f"{state}/log/batch={n}")

    def dimensions(self, layer: str = "ds") -> FX.Dimensions:
        return FX.Dimensions(customer=self.read_dim(layer, "customer"), store=self.read_dim(layer, "store"),
                             product=self.read_dim(layer, "product"), calendar=self.read_dim(layer, "calendar"))


def _dw_dim(name: str, ds: DataFrame) -> DataFrame:
    cols = DIMENSIONS[name][3] + [c for c in S.SCD_COLS if c in ds.columns]
    return ds.select(*cols)


def run_initial_load(spark: SparkSession, src: Sources, root: str, as_of: _dt.datetime,
                     dims_loaded_at: _dt.datetime, params: Params = DEFAULT, load_id: str = "initial") -> dict:
    """Initial full load: dimensions (staged with load and history columns,
    then published) and the fact of every transaction present.  It may be run
    again while nothing else has been loaded and no dimension has changed; after
    that it is refused before anything is written."""
    st = Store(spark, root)
    if st.place(load_id) != 1 or st.has_later_snapshots():
        raise RuntimeError("the warehouse has been loaded and has changed since: an initial load would give its members other keys")
    built = loads.build_dimensions(src)
    for name in DIMENSIONS:
        _, flag, _, _ = DIMENSIONS[name]
        ds = scd2.initialise(D.load_columns(getattr(built, name), flag, dims_loaded_at, True), params.open_dvf,
                             params.open_dvu)
        st.write_dim("ds", name, ds, 0)
        st.write_dim("dw", name, _dw_dim(name, st.read_dim("ds", name)), 0)
    st.write_dim("ds", "calendar", built.calendar, 0)
    st.write_dim("dw", "calendar", st.read_dim("ds", "calendar"), 0)
    return _fact_load(st, load_id, "initial", as_of, lambda dims, state: FX.intermediate_fact(src))


def _extend_calendar(st: Store, src: Sources) -> None:
    """New days for transactions outside the calendar; a DW calendar that lags
    behind (an earlier run died in between) is brought in line."""
    cal = st.read_dim("ds", "calendar")
    grown = D.extend_calendar(src, cal).checkpoint(eager=True)
    n = grown.count()
    if n > cal.count():
        st.write_dim("ds", "calendar", grown)
    if st.latest_snapshot("dw", "calendar") is None or n > st.read_dim("dw", "calendar").count():
        st.write_dim("dw", "calendar", grown)


def _fact_load(st: Store, load_id: str, kind: str, as_of: _dt.datetime, compute, src: Sources | None = None) -> dict:
    """One fact load.  ``compute`` gives the lines to load; lines that earlier
    loads found no keys for are tried again with them."""
    seq = st.place(load_id)
    if src is not None:
        _extend_calendar(st, src)
    dims = st.dimensions("ds")
    state = st.read_fact("ds", exclude_load=load_id, keep_partitions=True)
    lines = compute(dims, state).select(*S.INTERMEDIATE_COLS)
    again = st.read_unresolved(st.previous(load_id)).select(*S.INTERMEDIATE_COLS)
    again = again.join(lines.select(*FX.LINE_KEY), FX.LINE_KEY, "left_anti").select(*S.INTERMEDIATE_COLS)
    # materialised once: facts and unresolved lines must agree
    lines = lines.unionByName(again).checkpoint(eager=True)
    st.forget_in_marts(load_id)
    # the staged facts are computed and written once; all else is read from them.
    # They are flagged as published at once: until the log names the load, nobody
    # reads either layer's part of it.
    keyed = FX.resolve_fact_keys(lines, dims, as_of, **_large_lookups(dims, lines))
    st.write_fact("ds", load_id, L.mark_loaded(keyed.select(*S.FACT_DS_COLS), "f_loaded"), dims.calendar)
    new = st.written_load(load_id)
    st.write_fact("dw", load_id, new.select(*S.FACT_DW_COLS, "fact_year", "fact_month"))
    st.write_tid_index(load_id, new)
    st.write_unresolved(load_id, FX.unresolved_facts(lines, dims))
    n, left = new.count(), st.read_unresolved(load_id).count()
    st.write_log(load_id, kind, as_of, n, seq)
    return {"load_id": load_id, "kind": kind, "rows": n, "unresolved": left}


def _large_lookups(dims: FX.Dimensions, lines: DataFrame) -> dict:
    """Dimensions too large to broadcast are carried forward to the lines, and
    their frequent members kept apart."""
    natural = {"customer": "CustomerId", "store": "StoreId", "product": "ProductId"}
    large = tuple(n for n in natural if getattr(dims, n).count() > DEFAULT.carry_above)
    return {"carried": large, "hot": {n: lookup.hot_members(lines, natural[n]) for n in large}}


def run_daily_refresh(spark: SparkSession, src: Sources, root: str, as_of: _dt.datetime, load_id: str) -> dict:
    """Daily fact refresh above the high-water mark of the earlier loads."""
    st = Store(spark, root)
    mark = st.mark(exclude_load=load_id)

    def compute(dims, state):
        if mark is None:  # nothing is later than an unknown mark
            return FX.intermediate_fact(src, mark, bounded=True)
        # the guard only reads facts dated after the mark: prune to its year
        recent = state.filter(F.col("fact_year") >= mark.year)
        return loads.daily_lines(src, dims, recent, F.lit(mark))
    return _fact_load(st, load_id, "daily", as_of, compute, src)


def run_late_fact_refresh(spark: SparkSession, src: Sources, root: str, as_of: _dt.datetime, load_id: str) -> dict:
    """Recover transactions that arrived after the load that covered their date."""
    st = Store(spark, root)
    return _fact_load(st, load_id, "late", as_of, lambda dims, state: late_lines(st, src, load_id), src)


def late_lines(st: Store, src: Sources, load_id: str, within: tuple[str, str] | None = None) -> DataFrame:
    """Late lines, with the loaded TIDs read from the bucketed index (``within``:
    the smallest and largest id among the transactions of ``src``)."""
    return FX.late_facts(src, sales_tids=st.loaded_tids("S", load_id, within), rental_tids=st.loaded_tids("R", load_id, within))


def run_load_audit(spark: SparkSession, root: str, load_id: str) -> dict:
    """Foreign-key audit of one finished load: rows without a dimension row, by
    dimension, kept under ``audits/``.  No other load is read."""
    st = Store(spark, root)
    found = A.load_orphan_audit(st.read_fact("dw", only=[load_id]), st.dimensions("dw"))
    found.coalesce(1).write.mode("overwrite").parquet(f"{st.root}/audits/load_id={load_id}")
    return {r.Dimension: r.OrphanRows for r in spark.read.parquet(f"{st.root}/audits/load_id={load_id}").collect()}


def run_dimension_refresh(spark: SparkSession, src: Sources, root: str, as_of: _dt.datetime,
                          params: Params = DEFAULT) -> dict:
    """Add new customers, stores and products (keys above the largest in use).

    DS is written first, which fixes the new keys; DW then gets every DS row
    whose key it lacks.  Both get the new rows as a part beside the snapshot they
    have, which is not written again.  The keys come from a block reserved for
    this run.  Nothing is written where nothing is new, and a rerun after a
    failure in between completes the DW."""
    st = Store(spark, root)
    out = {}
    refreshers = {"customer": lambda d: D.refresh_customer_dimension(src, d, as_of, params.customer_stamp_lag_days,
                                                                     params.open_dvu),
                  "store": lambda d: D.refresh_store_dimension(src, d, as_of, params.open_dvu),
                  "product": lambda d: D.refresh_product_dimension(src, d, as_of, params.open_dvu)}
    for name, refresh in refreshers.items():
        _, flag, key, _ = DIMENSIONS[name]
        cur = st.read_dim("ds", name)
        new = _in_own_block(st, name, refresh(cur).select(*cur.columns).checkpoint(eager=True), f"refresh {as_of}")
        out[name] = new.count()
        if out[name]:
            st.append_dim("ds", name, L.mark_loaded(new, flag))
        published = st.read_dim("dw", name)
        missing = _dw_dim(name, st.read_dim("ds", name)).join(published.select(key), key, "left_anti")
        if not missing.isEmpty():
            st.append_dim("dw", name, missing.select(*published.columns))
    return out


def _in_own_block(st: Store, name: str, new: DataFrame, job: str) -> DataFrame:
    """New members with their keys, which follow the largest key the job has
    seen, moved to a block that no other job gets."""
    key = DIMENSIONS[name][2]
    lowest, n = new.agg(F.min(key), F.count(F.lit(1))).first()
    if not n:
        return new
    return new.withColumn(key, F.col(key) + (st.reserve_keys(name, n, lowest - 1, job) - lowest))


def run_scd2_products(spark: SparkSession, src: Sources, root: str, as_of: _dt.datetime,
                      params: Params = DEFAULT) -> dict:
    """One Type 2 round on the product dimension, then ``REPLACE INTO`` the DW
    (rows that only the DW has stay), then an audit of the facts' product keys.
    DS is written first: a rerun after a failure finds no change left in it and
    completes the DW with the same keys."""
    st = Store(spark, root)
    return _type_2_round(st, "product", scd2.apply_changes(src, st.read_dim("ds", "product"), as_of, params.open_dvu))


#: Compared columns and key order of the members that :func:`run_scd2_members` serves.
MEMBERS = {"customer": (D.customer_rows, ["CustomerID"], ["CustomerName", "CustomerZip"], D.CUSTOMER_ORDER),
           "store": (D.store_rows, ["StoreID"], ["StoreZip", "RegionID", "RegionName"], D.STORE_ORDER)}


def run_scd2_members(spark: SparkSession, src: Sources, root: str, name: str, as_of: _dt.datetime,
                     params: Params = DEFAULT) -> dict:
    """One Type 2 round on the customer or the store dimension."""
    st = Store(spark, root)
    rows, natural, tracked, order = MEMBERS[name]
    _, flag, key, _ = DIMENSIONS[name]
    return _type_2_round(st, name, scd2.apply_generic(rows(src), st.read_dim("ds", name), as_of, natural, tracked, order, key, flag, params.open_dvu))


def _type_2_round(st: Store, name: str, nxt: DataFrame) -> dict:
    """Write the dimension after a Type 2 round to DS and, where that differs,
    to DW.  The new versions get a block of keys of their own."""
    _, flag, key, _ = DIMENSIONS[name]
    nxt = nxt.checkpoint(eager=True)
    fresh = nxt.filter(~F.col(flag))
    versions = fresh.count()
    if versions:
        as_of = fresh.agg(F.max("ExtractionTimestamp")).first()[0]
        nxt = nxt.filter(flag).unionByName(_in_own_block(st, name, fresh, f"type 2 {as_of}")).checkpoint(eager=True)
        st.write_dim("ds", name, L.mark_loaded(nxt, flag))
    old, staged = st.read_dim("dw", name), _dw_dim(name, nxt)
    dw = L.upsert(old, staged, [key]).checkpoint(eager=True)
    if not staged.exceptAll(old.select(*staged.columns)).isEmpty():
        st.write_dim("dw", name, dw)
    orphans = st.read_fact("dw").groupBy(key).count().join(dw.select(key), key, "left_anti")
    return {"rows": nxt.count(), "new_versions": versions, "orphan_keys": orphans.count()}


def run_daily_store_snapshot(spark: SparkSession, root: str, params: Params = DEFAULT) -> DataFrame:
    """Bring the snapshot mart up to the finished loads, and audit its primary
    key and its day and store keys.

    The loads that are new since the last run form a batch.  What it adds to the
    additive form of the snapshot is computed from its own facts and, of the
    earlier ones, those of the months it touches; these months of the mart are
    then written again from the batches' additions.  Each step replaces whole
    directories and the batch is noted last, so a run that died is run again.
    Facts refer to versions of members, whose category and zip codes never change,
    so additions stay valid when dimensions grow."""
    st = Store(spark, root)
    dims = st.dimensions("dw")
    state, mart = st.state_path(params), f"{st.root}/marts/daily_store_snapshot"
    applied = st.batches(state)
    done = {i for members in applied.values() for i in members}
    order = [r[0] for r in st.read_log().orderBy("seq").select("load_id").collect()]
    batch = [i for i in order if i not in done]
    published = st.exists(f"{mart}/_parameters-{state[-8:]}")
    if not batch and published:
        return _snapshot_mart(st, mart)
    if batch:
        n = max(applied, default=-1) + 1
        at = f"{state}/batch={n}"
        touched = {*st._months(at)}  # also those of an earlier attempt
        for load_id in batch:
            touched |= {*st.load_months("dw", load_id)}
        first = order.index(batch[0])
        earlier = st.read_fact("dw", only=[i for i in order[:first] if i in done], months=sorted(touched))
        added = M.snapshot_delta(st.read_fact("dw", only=batch), earlier, dims, params)
        ym = dims.calendar.select("Calendar_Key", F.col("CalendarYear").alias("fact_year"), F.col("CalendarMonth").alias("fact_month"))
        (added.join(F.broadcast(ym), "Calendar_Key").hint("rebalance", "fact_year", "fact_month")
         .write.mode("overwrite").partitionBy("fact_year", "fact_month").parquet(at))
    # a mart of other parameters, or none, is written whole
    current = sorted({m for n in [*applied, *([n] if batch else [])] for m in st._months(f"{state}/batch={n}")})
    if published:
        current = [m for m in current if m in touched]
        for y, m in touched - {*current}:
            st.remove(f"{mart}/fact_year={y}/fact_month={m}")
    else:
        st.remove(mart)
    if current:
        states = (spark.read.schema(STATE_SCHEMA).option("basePath", state).parquet(*[f"{state}/batch={k}" for k in [*applied, *([n] if batch else [])]])
                  .filter((F.col("fact_year") * 12 + F.col("fact_month")).isin([y * 12 + m for y, m in current])))
        months = states.select("Calendar_Key", "fact_year", "fact_month").distinct()
        snap = M.snapshot_of_state(M.merge_states(states)).join(F.broadcast(months), "Calendar_Key")
        (snap.hint("rebalance", "fact_year", "fact_month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("fact_year", "fact_month").parquet(mart))
    if batch:
        spark.createDataFrame([(i,) for i in batch], "load_id string").coalesce(1).write.mode("overwrite").parquet(f"{state}/log/batch={n}")
    st._fs(mart).mkdirs(st._Path(f"{mart}/_parameters-{state[-8:]}"))
    snap = _snapshot_mart(st, mart)
    _audit(st, "daily_store_snapshot", snap, M.GRAIN, [("Calendar_Key", dims.calendar), ("Store_Key", dims.store)])
    return snap


SNAPSHOT_SCHEMA = ("TotalUnitSold long, TotalRevenueGenerated decimal(18,2), TotalNumberOfTransactions long, AverageRevenueGenerated decimal(10,2), "
                   "TotalFootwearRevenue decimal(18,2), NumberOfHVTransaction long, TotalLocalRevenue decimal(18,2), Calendar_Key long, Store_Key long")


def _snapshot_mart(st: Store, mart: str) -> DataFrame:
    cols = [c.split(" ")[0] for c in SNAPSHOT_SCHEMA.split(", ")]
    return st.spark.read.schema(f"{SNAPSHOT_SCHEMA}, fact_year int, fact_month int").parquet(mart).select(*cols)


def _audit(st: Store, mart: str, df: DataFrame, key: list[str], references: list[tuple[str, DataFrame]]) -> dict:
    """Primary- and foreign-key audit of a mart: counts of duplicated keys, and
    of keys without a dimension row, kept beside the mart."""
    found = {"duplicated_keys": A.primary_key_audit(df, key).first().DuplicatedKeys}
    for column, dim in references:
        found[f"orphan_{column}"] = df.select(column).distinct().join(dim.select(column), column, "left_anti").count()
    (st.spark.createDataFrame([*found.items()], "Audit string, Violations long").coalesce(1)
     .write.mode("overwrite").parquet(f"{st.root}/marts/{mart}_audit"))
    return found


def run_category_rollup(spark: SparkSession, root: str) -> dict:
    """Product-category dimension and the one-way category aggregate, written
    to the marts, with their primary and foreign keys audited (the original adds
    them as constraints after the copy to the DW)."""
    st = Store(spark, root)
    dims = st.dimensions("dw")
    cats = D.product_cat_dimension(dims.product)
    cats.write.mode("overwrite").parquet(f"{st.root}/marts/product_cat_dimension")
    cats = spark.read.parquet(f"{st.root}/marts/product_cat_dimension")
    agg = M.one_way_revenue_by_category(st.read_fact("dw"), dims.product, cats)
    agg.write.mode("overwrite").parquet(f"{st.root}/marts/one_way_revenue_by_category")
    agg = spark.read.parquet(f"{st.root}/marts/one_way_revenue_by_category")
    of_cats = _audit(st, "product_cat_dimension", cats, ["Product_cat_Key"], [])
    of_agg = _audit(st, "one_way_revenue_by_category", agg, ["Calendar_Key", "Customer_Key", "Store_Key", "Product_cat_Key"],
                    [("Calendar_Key", dims.calendar), ("Customer_Key", dims.customer), ("Store_Key", dims.store), ("Product_cat_Key", cats)])
    return {"categories": cats.count(), "rows": agg.count(),
            "duplicated_keys": of_cats["duplicated_keys"] + of_agg["duplicated_keys"],
            "orphan_keys": sum(v for k, v in of_agg.items() if k.startswith("orphan_"))}
