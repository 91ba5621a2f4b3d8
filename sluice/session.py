"""Session settings for tests, benchmarks and local runs.

On a cluster the session comes from the platform; nothing in the package builds one.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(app: str = "sluice", cpus: int | None = None) -> SparkSession:
    cores = str(cpus) if cpus else os.environ.get("BENCH_CPUS", "8")
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SLUICE_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder for written intermediate tables and stream checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. Only a session in local mode without
    that setting gets a fresh machine-local folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    made = tempfile.mkdtemp(prefix="sluice-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made
