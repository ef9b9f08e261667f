"""Session helpers: a tuned SparkSession and the shared folder for lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Settings the plans want where nobody has chosen otherwise.
RUNTIME_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None, app: str = "tillcast") -> SparkSession:
    """The running session, or a new one in which every setting of the submitter stands.

    ``master`` and ``shuffle_partitions`` are for local runs (tests, bench): with a master
    the session also gets the local defaults (no web page, driver memory).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = (builder.master(master).config("spark.ui.enabled", "false")
                   .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
                   .config("spark.driver.memory", os.environ.get("TILLCAST_DRIVER_MEMORY", "16g")))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    submitted = spark.sparkContext.getConf()
    for key, value in RUNTIME_DEFAULTS.items():
        if not submitted.contains(key):
            spark.conf.set(key, value)
    spark.sparkContext.setLogLevel("ERROR")
    tune(spark)
    return spark


# Rows of one window group (one machine) kept in the fast in-memory buffer before the
# window operator moves to its external buffer: 20 years of daily rows plus holiday
# fan-out fit (about 5 MB per task at ~300 bytes a row).
WINDOW_BUFFER_ROWS = 16_384


def tune(spark: SparkSession) -> None:
    """Settings every plan of this package relies on; safe to call on any session."""
    current = int(spark.conf.get("spark.sql.windowExec.buffer.in.memory.threshold", "4096"))
    if current < WINDOW_BUFFER_ROWS:
        spark.conf.set("spark.sql.windowExec.buffer.in.memory.threshold", str(WINDOW_BUFFER_ROWS))
    shared_dir(spark)


def is_local(master: str) -> bool:
    """True if driver and executors are one process (not ``local-cluster``)."""
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """Folder shared by all executors for checkpoints and written intermediates.

    Taken from ``spark.checkpoint.dir`` (set by the cluster). Only when it is unset and the
    master is local, as in tests, a private temporary folder is created and registered;
    elsewhere a machine-local folder would be lost on other machines, so it is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session has no local context: conf only
        sc = None
    base = spark.conf.get("spark.checkpoint.dir", None) or (sc.getCheckpointDir() if sc else None)
    if not base:
        if sc is None or not is_local(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="tillcast-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder (never a machine-local temp dir on a cluster)."""
    return f"{shared_dir(spark).rstrip('/')}/tillcast/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written once to the cluster's shared folder and read back: later jobs reuse it, and a
    lost executor costs no recomputation."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder; survives executor loss."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
