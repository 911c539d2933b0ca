"""Session construction and the shared work folder.

Cluster deployments pass their own session; ``tune`` only pins settings the
results depend on (UTC session time, ANSI casts) and keeps adaptive execution
on, so shuffle partition counts, memory and broadcast limits stay the
operator's choice. ``local_session`` is what tests and the bench use.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings whose value changes results or plan safety; everything else is left
# to the cluster configuration.
_REQUIRED = {
    # Event-time windows and NTZ -> TIMESTAMP casts are evaluated in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce small shuffles, split skewed join
    # partitions, turn a join into a broadcast only once its measured size is
    # under the threshold.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Pin the result-relevant settings on an existing session."""
    for key, value in _REQUIRED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "cinelake", extra: dict | None = None) -> SparkSession:
    """A local[N] session for tests and the bench (no UI, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("CINELAKE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.forceDeleteTempCheckpointLocation", "true")
    )
    for key, value in {**_REQUIRED, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def work_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints, stream state and staged tables.

    It comes from the cluster (``spark.checkpoint.dir`` or the context's
    checkpoint dir). Only on a local master with neither set, as in tests, a
    folder of our own is created and registered so later calls agree; other
    masters must set one, as executors do not share the driver's disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = _context(spark)
    if not folder and context is not None:
        folder = context.getCheckpointDir()
    if not folder:
        master = context.master if context is not None else "unknown"
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors share (master {master})")
        folder = tempfile.mkdtemp(prefix="cinelake-")
        if context is not None:
            context.setCheckpointDir(folder)
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None over Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused location under the work folder (one per run)."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
