"""A local Spark session for tests and benchmarks."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cpus: int = 8) -> SparkSession:
    """A local session; on a cluster the submitter sets these."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidemark")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
