"""Session construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job wants: adaptive execution (coalescing, skew split),
# a fixed session zone so text times never depend on the client machine.
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # remove checkpoint files once the pinned DataFrame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "quire", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the base settings.

    On a cluster leave ``master`` None and let spark-submit decide; tests
    pass ``local[*]``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        builder = builder.config("spark.driver.memory", os.environ.get("QUIRE_DRIVER_MEM", "16g"))
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only if none is configured.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS/S3) folder and is
    used as is. Only when nothing is configured (local tests) is a fresh
    folder under the system temp directory created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) for cluster runs")
        conf_dir = tempfile.mkdtemp(prefix="quire-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def session_key(spark: SparkSession) -> tuple[int, str]:
    """Identity of a live session: the object plus its SparkContext's application
    id (a stopped and recreated context never matches an old key)."""
    return id(spark), spark.sparkContext.applicationId


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/quire-{name}-{uuid.uuid4().hex[:12]}"
