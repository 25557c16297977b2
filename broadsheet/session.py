"""Session settings the operators rely on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

#: Rows in an Arrow batch: bounds what a Python worker holds of long texts.
BATCH_ROWS = 256

# Settings that change results (time zone), bound memory or let AQE split hot join keys.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A split of a hot key is worth an extra exchange further up the plan.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS),
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else started."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", app: str = "broadsheet") -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    partitions = os.cpu_count() if cpus == "*" else int(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
    )
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable.

    A cluster names a shared folder in ``spark.checkpoint.dir``. Only a local
    session, where driver and executors share one disk, gets a temporary one.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    shared = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if shared:
        context.setCheckpointDir(shared)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="broadsheet-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
