"""Session defaults: adaptive execution, UTC, and no inference of anything."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_spark(app: str = "lexweft", cores: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).master(f"local[{cores}]")
    defaults = {"spark.sql.shuffle.partitions": str(shuffle_partitions), "spark.sql.adaptive.enabled": "true", "spark.sql.session.timeZone": "UTC", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
