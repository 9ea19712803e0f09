"""Session construction and lineage-cut support."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "feedlens") -> SparkSession:
    """Session with the settings every job here assumes.

    * UTC session time zone: event times are wall-clock (TIMESTAMP_NTZ) in
      batch and are cast to TIMESTAMP only for streaming watermarks.
    * AQE on: small per-day aggregates are broadcast at runtime, skewed
      shuffle partitions are split, tiny partitions are coalesced.
    * No UI server.
    * Checkpoint files of a DataFrame go when nothing refers to it any more.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset and let the
    cluster configuration decide.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None under Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of this session.

    The cluster names a shared folder in ``spark.checkpoint.dir``; it is used
    as given.  Only in local mode without the setting (unit tests, local
    runs) a private scratch folder is created; on a cluster a missing
    setting is an error.
    """
    sc = _context(spark)
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not str(master).startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder shared by all "
                               "executors (a machine-local folder cannot be read back)")
        configured = tempfile.mkdtemp(prefix="feedlens-ckpt-")   # local mode only (tests)
    if sc is not None:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    return configured


def materialize(df):
    """Write ``df`` once to the reliable checkpoint folder and return a
    DataFrame reading it.

    Used for small derived tables (one row per user) that several branches
    or scalar subqueries of one job read: each of them would otherwise
    re-derive it from the raw events.  The lineage is cut, so a lost
    executor recomputes from the checkpoint, not from the raw scan."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_path(spark: SparkSession, name: str) -> str:
    """A path for job state (stream checkpoints, written tables) under the
    shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name)
