"""Distributed suffix sorting by a difference cover (Kärkkäinen and Sanders' skew algorithm on DataFrames).

Strings are tables ``sid, lane, j, name``: symbol ``name`` (long) at place ``j`` = 0, 1, 2 ... of string
``(sid, lane)``. Suffixes at places 1 and 2 modulo 3 are sampled: their triples are sorted and named, the names make
up two strings a third as long each, and these are sorted recursively, until a name covers as many symbols as are to
be compared. The remaining suffixes follow by a symbol and a sampled rank, and all are merged: any two classes have a
common key (one or two symbols and a sampled rank), so counting smaller suffixes of the other classes in three sorts
gives every place. All sorts are by range partition; the driver sees one row of counts per partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusforge.llm.common import Scratch

_least = -(1 << 63)
#: Classes whose smaller members count, by comparison (of classes 0-1, 0-2, 1-2) and own class.
_counted = {(0, 0): (0, 1), (0, 1): (0, 1), (1, 0): (2,), (1, 2): (0, 2), (2, 1): (2,), (2, 2): (1,)}


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Within one sorted partition, per row: rows of classes 0, 1, 2 and distinct keys below its key.

    Keys are ``which, a, b, c``; counts start anew with each ``which``.
    """
    total, at_group, last = np.zeros(4, dtype=np.int64), np.zeros(4, dtype=np.int64), None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        key = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in ("which", "a", "b", "c")])
        cls = batch.column("cls").to_numpy(zero_copy_only=False)
        prev = np.concatenate([key[:, :1] if last is None else last[:, None], key[:, :-1]], axis=1)
        new = (key != prev).any(axis=0)
        if last is None:
            new[0] = True
        fresh = key[0] != prev[0]  # another comparison begins
        each = np.zeros((n, 4), dtype=np.int64)
        for k in range(3):
            each[:, k] = cls == k
        each[:, 3] = new
        upto = np.cumsum(each, axis=0)
        before = upto - each + total  # rows ahead, from the partition's (or comparison's) start
        before[:, 3] = upto[:, 3] + total[3] - 1  # groups ahead of one's own
        reset = np.zeros((n, 4), dtype=np.int64)
        for i in np.flatnonzero(fresh):
            reset[i:] = before[i]
        before = before - reset
        first = np.maximum.accumulate(np.where(new, np.arange(n), -1))
        out = np.where((first >= 0)[:, None], before[np.maximum(first, 0)], at_group)
        at_group = out[-1].copy()
        total = upto[-1] + total - reset[-1]
        last = key[:, -1].copy()
        yield pa.RecordBatch.from_arrays(
            [batch.column(k) for k in ("sid", "lane", "j", "which", "cls", "pid")] + [pa.array(np.ascontiguousarray(out[:, k])) for k in range(4)],
            names=["sid", "lane", "j", "which", "cls", "pid", "l0", "l1", "l2", "groups"],
        )


def _sorted_tally(rows: DataFrame, tmp: Scratch, name: str) -> tuple[DataFrame, DataFrame]:
    """``_tally`` of a globally sorted table, and per partition and comparison what lies in earlier partitions."""
    ordered = rows.repartitionByRange("which", "a", "b", "c").sortWithinPartitions("which", "a", "b", "c").withColumn("pid", F.spark_partition_id().cast("long"))
    schema = "sid long, lane long, j long, which int, cls int, pid long, l0 long, l1 long, l2 long, groups long"
    done = tmp.keep(ordered.select("sid", "lane", "j", F.col("which").cast("int"), F.col("cls").cast("int"), "pid", "a", "b", "c").mapInArrow(_tally, schema), name)
    counts = done.groupBy("pid", "which").agg(*[F.sum((F.col("cls") == k).cast("long")).alias(f"t{k}") for k in range(3)], (F.max("groups") + 1).alias("t3")).collect()
    sums: dict[int, list[int]] = {}
    offsets = []
    for r in sorted(counts, key=lambda r: (r["which"], r["pid"])):
        ahead = sums.setdefault(r["which"], [0, 0, 0, 0])
        offsets.append((r["pid"], r["which"], *ahead))
        sums[r["which"]] = [x + r[f"t{k}"] for k, x in enumerate(ahead)]
    table = rows.sparkSession.createDataFrame(offsets, "pid long, which int, o0 long, o1 long, o2 long, o3 long")
    return done, F.broadcast(table)  # a few rows per partition


def suffix_ranks(strings: DataFrame, need: int, tmp: Scratch, cover: int = 1) -> DataFrame:
    """``sid, lane, j, rank``: order of all suffixes; suffixes that agree in their first ``need`` symbols (or to
    their ends) may share a rank. Each name in ``strings`` stands for ``cover`` symbols of the first level."""
    if cover >= need:
        return strings.select("sid", "lane", "j", F.col("name").alias("rank"))
    here = Window.partitionBy("sid", "lane").orderBy("j")
    none = F.lit(_least).cast("long")
    x = strings.select("sid", "lane", "j", "name", F.coalesce(F.lead("name", 1).over(here), none).alias("n1"), F.coalesce(F.lead("name", 2).over(here), none).alias("n2"))
    x = tmp.keep(x.withColumn("cls", (F.col("j") % 3).cast("int")), f"symbols-{cover}")

    triples = x.where("cls <> 0").select("sid", "lane", "j", F.lit(0).alias("which"), F.col("name").alias("a"), F.col("n1").alias("b"), F.col("n2").alias("c"), "cls")
    done, offsets = _sorted_tally(triples, tmp, f"triples-{cover}")
    named = done.join(offsets, ["pid", "which"]).select("sid", (F.col("lane") * 2 + F.col("cls") - 1).alias("lane"), F.floor(F.col("j") / 3).cast("long").alias("j"), (F.col("groups") + F.col("o3")).alias("name"))
    ranks = suffix_ranks(named, need, tmp, cover * 3)
    ranks = ranks.select("sid", F.shiftright("lane", 1).alias("lane"), (F.col("j") * 3 + 1 + F.col("lane").bitwiseAND(F.lit(1).cast("long"))).alias("j"), "rank")

    y = x.join(ranks, ["sid", "lane", "j"], "left")
    after = [F.coalesce(F.lead("rank", k).over(here), F.lit(-1).cast("long")) for k in (1, 2)]
    y = y.select("*", after[0].alias("r1"), after[1].alias("r2"))
    zero = F.lit(0).cast("long")
    keys = {0: ("name", "r1", zero), 1: ("name", "n1", "r2"), 2: ("rank", zero, zero)}

    def entry(which: int):
        a, b, c = (F.col(k) if isinstance(k, str) else k for k in keys[which])
        return F.struct(F.lit(which).alias("which"), a.alias("a"), b.alias("b"), c.alias("c"))

    takes = F.when(F.col("cls") == 0, F.array(entry(0), entry(1))).when(F.col("cls") == 1, F.array(entry(0), entry(2))).otherwise(F.array(entry(1), entry(2)))
    merged = y.select("sid", "lane", "j", "cls", F.explode(takes).alias("e")).select("sid", "lane", "j", "cls", "e.*")
    done, offsets = _sorted_tally(merged, tmp, f"merge-{cover}")
    tmp.drop(f"symbols-{cover}", f"triples-{cover}")
    below = F.lit(0).cast("long")
    for (which, cls), classes in _counted.items():
        below = F.when((F.col("which") == which) & (F.col("cls") == cls), sum((F.col(f"l{k}") + F.col(f"o{k}") for k in classes[1:]), F.col(f"l{classes[0]}") + F.col(f"o{classes[0]}"))).otherwise(below)
    out = tmp.keep(done.join(offsets, ["pid", "which"]).select("sid", "lane", "j", below.alias("v")).groupBy("sid", "lane", "j").agg(F.sum("v").alias("rank")), f"ranks-{cover}")
    tmp.drop(f"merge-{cover}", f"ranks-{cover * 3}")
    return out
