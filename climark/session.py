"""Session construction and the shared scratch location.

Jobs never invent a machine-local temp folder: intermediate tables and
streaming checkpoints live under ``spark.checkpoint.dir``, the shared folder
the cluster names.  Where it is unset, a ``local`` master gets a private folder
(unit tests, laptops) and any other master an error.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str | None = None, app: str = "climark",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None, driver_memory: str = "8g") -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": driver_memory,
        # materialised intermediates are removed once no longer referenced
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a private one only if unset."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - e.g. a remote (Connect) session
        sc = None
    path = spark.conf.get(CHECKPOINT_KEY, None) or (sc.getConf().get(CHECKPOINT_KEY, None) if sc else None)
    if not path:
        if sc is None or not sc.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="climark-ckpt-")  # one machine (tests, laptops)
        spark.conf.set(CHECKPOINT_KEY, path)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint dir (unique per call)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/climark/{name}-{uuid.uuid4().hex[:12]}"
