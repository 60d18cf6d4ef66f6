"""Incremental fact loading driven by a stream of transaction arrivals.

The operational system (or its change feed) lands files that list the
transactions entered since the last file: ``(tid, entered_at)``.  Each
micro-batch loads the lines of the arrived transactions that have no fact of
their kind yet — the late-fact rule, which also covers new transactions —
as one fact load whose id is the batch id.

Exactly once: the stream's checkpoint records which files each batch read; a
load's id is made of that checkpoint's own identity and the batch number, so
a replayed batch meets its own load (finished: it is skipped; begun: its
directories are replaced), and another stream, or the same one with a new
checkpoint, never does.  The anti join against the loaded fact refuses lines
already present, and batches need not come in the order of their events.  With
``trigger(availableNow=True)`` the query processes what has landed and
stops, so a scheduler can run it like the daily procedure."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import jobs
from ..session import ensure_checkpoint_dir
from ..sources import Sources

ARRIVAL_SCHEMA = "tid string, entered_at timestamp_ntz"


def arrivals(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(ARRIVAL_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def narrow_to(src: Sources, arrived: DataFrame) -> Sources:
    """The operational tables restricted to the arrived transactions."""
    return src.replace(salestransaction=src.salestransaction.join(arrived, "tid", "left_semi"),
                       rentaltransaction=src.rentaltransaction.join(arrived, "tid", "left_semi"))


def stream_id(spark: SparkSession, checkpoint_location: str) -> str:
    """The identity that Spark gave the stream when its checkpoint was made."""
    noted = spark.read.json(f"{checkpoint_location.rstrip('/')}/metadata").first()["id"]
    return noted.replace("-", "")[:12]


def start_incremental_load(spark: SparkSession, src: Sources, root: str, arrivals_path: str,
                           checkpoint_location: str, available_now: bool = True,
                           max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream; each batch is one fact load into ``root``.

    The batch's processing stamp is the latest ``entered_at`` it holds, so a
    replay stamps the same rows with the same time."""
    ensure_checkpoint_dir(spark)

    def process(batch: DataFrame, batch_id: int) -> None:
        arrived = batch.select("tid").distinct().checkpoint(eager=True)
        as_of, low, high = batch.agg(F.max("entered_at"), F.min("tid"), F.max("tid")).first()
        if as_of is None:
            return
        part = narrow_to(src, arrived)
        st = jobs.Store(spark, root)
        load_id = f"stream-{stream_id(spark, checkpoint_location)}-{batch_id:010d}"
        if load_id in st.load_ids():
            return  # the batch was loaded whole before the stream could note it
        jobs._fact_load(st, load_id, "stream", as_of, lambda dims, state: jobs.late_lines(st, part, load_id, (low, high)), part)

    writer = (arrivals(spark, arrivals_path, max_files_per_trigger).writeStream
              .foreachBatch(process).option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
