"""Connected components of an edge table by alternating large and small stars (Kiveris et al., 2014).

Each star takes a node's least neighbour by a pre-aggregated minimum, never a neighbour list, so a node may have any
number of edges. Labels end as the least node of the component. Self-loops and repeated edges do no harm; null ends
are dropped; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.checkpoint import cut


def _least(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` of every end of ``edges`` (``u, v`` long)."""
    e = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = cut(e)
    before = None
    while True:
        mark = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            break
        before = mark
        # Large star: a node's larger neighbours move to the least of the node and its neighbours.
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), F.col("u") == F.col("_u")).where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
        large = cut(large.where("u <> v").distinct())
        # Small star: a node and its smaller neighbours move to the least of these.
        moved = large.join(_least(large), F.col("u") == F.col("_u"))
        e = moved.select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        e = cut(e.where("u <> v").distinct())
    return e.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
