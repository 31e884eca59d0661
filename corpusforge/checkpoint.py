"""Cutting lineage in the folder that all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or a folder of our own where that is unset."""
    path = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    jsc = spark.sparkContext._jsc.sc()
    if not path and jsc.getCheckpointDir().isDefined():
        path = jsc.getCheckpointDir().get()
    if not path:
        path = tempfile.mkdtemp(prefix="corpusforge-")
    if not jsc.getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(path)
    return path


def lean_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Hand texts to Python workers in batches of at most ``rows``, so that workers stay small.

    The setting is read when a query is planned, which is after an operator returns; so it stays.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows:
        spark.conf.set(key, rows)


def cut(df: DataFrame) -> DataFrame:
    """An eager checkpoint, so that a lost executor costs no recomputation."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
