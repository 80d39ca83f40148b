"""Session helpers: local test sessions, and where lineage cuts and scratch tables go.

On a cluster the shared folder is named by ``spark.checkpoint.dir``; it is read from the session and
only replaced by a local temporary folder when nothing is configured (unit tests on a laptop).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", app: str = "pathlattice", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.serializer", "org.apache.spark.serializer.KryoSerializer")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # streaming state (one row per distinct edge, never expires) lives in RocksDB, not the JVM heap
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_base(spark)
    return spark


def checkpoint_base(spark: SparkSession) -> str:
    """The reliable checkpoint folder of this session; set one only when the session has none."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="pathlattice-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for tables a job writes and reads back."""
    base = checkpoint_base(spark).rstrip("/")
    return f"{base}/pathlattice-{name}-{uuid.uuid4().hex[:12]}"
