"""Session for tests and the local benchmark.  Clusters bring their own."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", app: str = "starmart") -> SparkSession:
    partitions = str(os.cpu_count() or 8) if cores == "*" else str(cores)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir.  Only a local session, whose one machine is driver and executor, may lack the
    setting; it gets a folder of its own.  On a cluster a missing setting is an error."""
    have = spark.conf.get("spark.checkpoint.dir", None)
    if not have:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        have = tempfile.mkdtemp(prefix="starmart-")
        spark.conf.set("spark.checkpoint.dir", have)
    return have.rstrip("/")
