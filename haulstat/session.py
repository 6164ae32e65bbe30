"""SparkSession construction shared by tests, bench and the driver entry points."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "haulstat") -> SparkSession:
    """Return the active session, or build a local one tuned for these workloads.

    On a cluster the caller's session already exists and is returned untouched,
    apart from the checkpoint directory, which is only set when the cluster has
    not named one (tests, local runs).
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("HAULSTAT_DRIVER_MEMORY", "16g"))
        .config("spark.sql.parquet.datetimeRebaseModeInRead", "CORRECTED")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_UNITS = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30,
          "t": 1 << 40, "tb": 1 << 40}


def broadcast_threshold_bytes(spark: SparkSession) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes (0 when broadcasting is disabled)."""
    try:
        value = int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
    except Exception:  # e.g. a Spark Connect session: read the setting as text
        text = str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10MB")).strip().lower()
        num = text.rstrip("bkmgt")
        unit = text[len(num):] or "b"
        value = int(float(num) * _UNITS.get(unit, 1))
    return max(value, 0)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint directory in use: the cluster's, or a scratch one only when none is named.

    ``spark.checkpoint.dir`` is a core setting read at start-up; on a cluster
    it names shared storage and is used as is. Only when it is unset (tests,
    local runs) is a scratch directory created for this process.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server's checkpoint directory applies
        return spark.conf.get("spark.checkpoint.dir", "") or ""
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if named:
        sc.setCheckpointDir(named)
        return named
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: name a shared directory for this cluster")
    path = tempfile.mkdtemp(prefix="haulstat-ckpt-")
    sc.setCheckpointDir(path)
    return path
