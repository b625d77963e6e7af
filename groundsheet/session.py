"""Session defaults for local runs; on a cluster the submitted configuration rules."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", app: str = "groundsheet", shuffle: int = 8) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("GROUNDSHEET_MEMORY", "12g"))
        .getOrCreate()
    )
