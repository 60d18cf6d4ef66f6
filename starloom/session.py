"""Session helpers: a tuned local session for tests/bench, checkpoint dir."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on; a cluster deployment sets the same keys.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # remove checkpoint files once their DataFrame is garbage-collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "starloom", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the benchmark (UI off, AQE on)."""
    b = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", os.environ.get("STARLOOM_DRIVER_MEMORY", "4g")))
    for k, v in {**JOB_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory the cluster names.

    Reads ``spark.checkpoint.dir`` from the session.  Only a local-mode
    session (tests) without one gets a fresh directory under the system temp
    folder; on a cluster a missing setting is an error, since a machine-local
    folder does not survive the loss of an executor.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect client: the server's setting applies
        return spark.conf.get("spark.checkpoint.dir", "")
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if sc.master == "local" or sc.master.startswith("local["):
        d = tempfile.mkdtemp(prefix="starloom-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        sc.setCheckpointDir(d)
        return sc.getCheckpointDir()
    raise RuntimeError("spark.checkpoint.dir is not set: surrogate-key assignment needs a "
                       "reliable checkpoint directory on shared storage")
