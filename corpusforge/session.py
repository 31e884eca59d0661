"""A session with the settings the engine expects."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build(master: str = "local[*]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    b = SparkSession.builder.master(master).appName("corpusforge")
    settings = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    } | conf
    for k, v in settings.items():
        b = b.config(k, v)
    return b.getOrCreate()
