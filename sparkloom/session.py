"""Session helpers for tests, the bench and command-line use.

Library functions never create a session; they use ``df.sparkSession``.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from sparkloom.errors import ValidationError

# Tuned for local runs; on a cluster these come from the cluster's own config.
LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.driver.memory": "16g",
    # explicit broadcasts are size-checked in code; keep the automatic threshold modest
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "sparkloom") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in LOCAL_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    from sparkloom.deploy import ship_package

    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only when a local session has none (tests) do we set one of our own, in its
    temporary folder; on a cluster a folder that all executors see must be configured.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):  # local-cluster runs executors of its own
            raise ValidationError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        configured = os.path.join(tempfile.gettempdir(), "sparkloom-checkpoints")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def staging_path(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared checkpoint directory for intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/sparkloom-staging/{label}-{uuid.uuid4().hex}"


BATCH_BYTES = 4 << 20


@contextmanager
def lean_jobs(spark: SparkSession) -> Iterator[None]:
    """Writes in here delete what they shuffled as soon as they end, and give Python workers Arrow batches of at most ``BATCH_BYTES`` (or one row).

    Otherwise Spark deletes shuffles when the driver collects the plan as garbage, so a loop of jobs fills the disk before;
    and a batch may have 64 MB.  A smaller bound that the user has set stays.
    """
    clean, bound = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.execution.arrow.maxBytesPerBatch"
    before = {key: spark.conf.get(key, None) for key in (clean, bound)}
    now = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(bound))
    spark.conf.set(clean, "true")
    if not 0 < now <= BATCH_BYTES:
        spark.conf.set(bound, str(BATCH_BYTES))
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
