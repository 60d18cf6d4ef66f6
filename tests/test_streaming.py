"""The arrival stream loads new and late transactions exactly once."""

import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from starloom import jobs
from starloom import schema as S
from starloom.plans.scenario import Warehouse
from starloom.streaming import start_incremental_load

KEY = S.FACT_KEY + ["RevenueGenerated", "UnitSolds"]


def test_arrival_stream_completes_the_fact(spark):
    root = tempfile.mkdtemp(prefix="starloom-st-wh-")
    landing = tempfile.mkdtemp(prefix="starloom-landing-")
    ckpt = tempfile.mkdtemp(prefix="starloom-stream-ckpt-")
    w = Warehouse(spark, SF_SMALL)
    p = w.p
    jobs.run_initial_load(spark, w.base_src, root, p.initial_as_of, p.dims_loaded_at, p)
    # arrivals: every transaction the initial load did not see, in two files
    all_tx = w.src.salestransaction.unionByName(w.src.rentaltransaction)
    base_tx = w.base_src.salestransaction.unionByName(w.base_src.rentaltransaction)
    later = all_tx.join(base_tx.select("tid"), "tid", "left_anti")
    new = later.filter(F.col("tdate") > p.base_cutoff).select(
        "tid", F.lit(p.refresh_as_of.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz").alias("entered_at"))
    late = later.filter(F.col("tdate") <= p.base_cutoff).select(
        "tid", F.lit("2001-09-02 02:00:00").cast("timestamp_ntz").alias("entered_at"))
    late.coalesce(1).write.mode("append").parquet(landing)
    new.coalesce(1).write.mode("append").parquet(landing)

    q = start_incremental_load(spark, w.src, root, landing, ckpt, max_files_per_trigger=1)
    q.awaitTermination(600)
    st = jobs.Store(spark, root)
    dw = st.read_fact("dw").select(*KEY)
    full = w.fact.select(*KEY)
    assert dw.count() == full.count() == 4431
    assert dw.exceptAll(full).count() == 0
    ids = sorted(st.load_ids())
    assert ids[0] == "initial" and [i.split("-")[-1] for i in ids[1:]] == ["0000000000", "0000000001"]
    # the second file was older than the first and loaded all the same
    late_rows = spark.read.parquet(landing).filter(F.col("entered_at") < "2001-09-02").count()
    assert late_rows > 0

    # a restarted stream with nothing new changes nothing
    q2 = start_incremental_load(spark, w.src, root, landing, ckpt, max_files_per_trigger=1)
    q2.awaitTermination(600)
    assert st.read_fact("dw").count() == 4431

    # a stream with a new checkpoint reads every file again and erases nothing
    q3 = start_incremental_load(spark, w.src, root, landing, tempfile.mkdtemp(prefix="starloom-stream-ckpt2-"), max_files_per_trigger=1)
    q3.awaitTermination(600)
    assert q3.exception() is None
    dw = st.read_fact("dw").select(*KEY)
    assert dw.count() == 4431 and dw.exceptAll(full).count() == 0
