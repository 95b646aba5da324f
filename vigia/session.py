"""Session helpers: defaults for a local run and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock for date rendering, AQE for runtime
# re-planning (partition coalescing, skew-join splitting, broadcast of small stages).
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Arrow batches for the HTML shredder: pages can be large, keep batches bounded.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "vigia") -> SparkSession:
    """A local session for tests and the bench; a cluster uses spark-submit settings instead."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("VIGIA_DRIVER_MEMORY", "8g"))
    )
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def pin_session(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on (time zone) to a session someone else built."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only a local session (tests) without one gets a scratch folder of our own: on a cluster a folder
    of the driver's machine is not seen by executors, so a missing setting is an error there."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if d:
        return d
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    d = tempfile.mkdtemp(prefix="vigia-ckpt-")
    spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d
