"""Numbering and running sums in a stated order without a single-partition window."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusforge.checkpoint import cut


def running_sum(df: DataFrame, order: list[str], value: Column, out: str, keys: list[str] | None = None) -> DataFrame:
    """Adds ``out``, the sum of ``value`` over earlier rows of the same keys in the given order.

    Rows are range-partitioned by keys and order; sums run within partitions, and the partitions' totals, one row per
    key and partition that holds it, give what lies ahead.
    """
    keys = keys or []
    ranged = cut(df.withColumn("_v", value).repartitionByRange(*keys, *order).withColumn("_pid", F.spark_partition_id()))
    inside = Window.partitionBy("_pid", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    totals = cut(ranged.groupBy("_pid", *keys).agg(F.sum("_v").alias("_t")))
    earlier = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    ahead = totals.select(F.col("_pid").alias("_p"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.coalesce(F.sum("_t").over(earlier), F.lit(0)).alias("_ahead"))
    on = F.col("_pid") == F.col("_p")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    joined = ranged.withColumn("_in", F.coalesce(F.sum("_v").over(inside), F.lit(0))).join(ahead, on)
    return joined.withColumn(out, (F.col("_in") + F.col("_ahead")).cast("long")).drop("_v", "_pid", "_in", "_p", "_ahead", *[f"_k{i}" for i in range(len(keys))])


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores, if its scan has fewer partitions than there are cores; a table of many files stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores * 2) if df.rdd.getNumPartitions() < cores * 2 else df


def with_index(df: DataFrame, order: list[str], out: str = "idx", keys: list[str] | None = None) -> DataFrame:
    """Adds the place of each row (from 0) in the given order, per key if there are any.

    Without keys, rows are shuffled once and come back in that order: a row's place in its range is the one it was kept
    at, and one count a range passes the driver.
    """
    if keys:
        return running_sum(df, order, F.lit(1).cast("long"), out, keys)
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = cut(ranged.withColumn("_pid", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id()))
    counts = sorted((r["_pid"], r["count"]) for r in ranged.groupBy("_pid").count().collect())
    ahead = np.cumsum([0, *(n for _, n in counts)]).tolist()
    offsets = df.sparkSession.createDataFrame([(p, a) for (p, _), a in zip(counts, ahead)], "_p int, _ahead long")
    placed = ranged.join(F.broadcast(offsets), F.col("_pid") == F.col("_p"))
    return placed.withColumn(out, F.col("_row").bitwiseAND((1 << 33) - 1) + F.col("_ahead")).drop("_pid", "_row", "_p", "_ahead")
