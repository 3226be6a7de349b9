"""A Spark session with the settings the library is tested under."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: str = "*", name: str = "worklens", **settings: str) -> SparkSession:
    """Local session for tests and measurements; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
