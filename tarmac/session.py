"""Session settings for tests, benchmarks and local runs.

On a cluster, the session comes from ``spark-submit`` and its own settings;
the library never requires these. Locally they keep shuffles sized to the
cores, adaptive execution on, the UI off, and a checkpoint folder set only
where the session does not name one.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(app: str = "tarmac", cores: int | str = "*", shuffle_partitions: int | None = None) -> SparkSession:
    parts = shuffle_partitions or (os.cpu_count() if cores == "*" else int(cores)) or 8
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ui.retainedExecutions", "10000")  # tests look up the plans of what they ran
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TARMAC_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tarmac-ckpt-", dir="/tmp"))
    return spark
