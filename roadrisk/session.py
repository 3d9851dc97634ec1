"""Session helper for tests, the bench and command-line runs.

On a cluster the caller's session is used as is; this helper only builds a
local one with settings suited to small inputs.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cpus: int | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    parts = shuffle_partitions or cpus
    spark = (SparkSession.builder
             .master(f"local[{cpus}]")
             .appName("roadrisk")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", str(parts))
             .config("spark.default.parallelism", str(parts))
             .config("spark.sql.adaptive.enabled", "true")
             # Shuffle partitions already equal the cores here, so coalescing can
             # only lose parallelism; it did, before fan-out steps (density,
             # neighbour sums) whose small input shuffle was merged into one task.
             .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             # Without it every Column operation asks the JVM four times for its call site.
             .config("spark.python.sql.dataFrameDebugging.enabled", "false")
             .config("spark.sql.session.timeZone", "UTC")
             # Checkpoint files go when nothing refers to them any more.
             .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
             .config("spark.driver.memory", os.environ.get("ROADRISK_DRIVER_MEMORY", "8g"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from roadrisk.sources.tables import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    return spark
