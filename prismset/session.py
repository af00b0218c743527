"""Session settings and table loading shared by every query."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "prismset", cpus: int | None = None) -> SparkSession:
    """A local session with the settings the queries are tested under."""
    n = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables, read lazily."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
