"""Cosine neighbours by blocks, and greedy leader clusters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.checkpoint import cut


#: Numbers of the vectors in one block of a tile, and of the similarities that are looked at in one go.
BLOCK_NUMBERS, PIECE = 1 << 21, 1 << 22
#: Edges in one batch.
EDGES = 100_000


def _cosine(m: np.ndarray, square: np.ndarray, r: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Similarities as DuckDB rounds them, which decides pairs that lie just at a threshold."""
    return np.einsum("ij,ij->i", m[r], m[c]) / np.maximum(np.sqrt(square[r] * square[c]), 1e-24)


def _near(ids: np.ndarray, m: np.ndarray, cut_at: int, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ends of the pairs at the threshold: rows before ``cut_at`` with those from there on, or all rows where it is 0.

    Single precision decides but for pairs whose similarity is as near the threshold as its error may reach.
    """
    square = np.einsum("ij,ij->i", m, m)
    rough, doubt = (m / np.maximum(np.sqrt(square), 1e-12)[:, None]).astype(np.float32), (m.shape[1] + 8) * 1.2e-7
    high = 1024
    wide = PIECE // high
    for x in range(0, cut_at or len(m), high):
        top = rough[x : min(x + high, cut_at or len(m))]
        for y in range(cut_at or x, len(m), wide):
            near = top @ rough[y : y + wide].T
            hit = near >= threshold - doubt
            # All of them may be at the threshold: then some rows are taken at a time.
            step = max(1, EDGES // hit.shape[1]) if np.count_nonzero(hit) > EDGES else len(hit)
            for k in range(0, len(hit), step):
                r, c = np.nonzero(hit[k : k + step])
                r += k
                unsure = np.flatnonzero(near[r, c] < threshold + doubt)
                r, c = r + x, c + y
                keep = np.ones(len(r), dtype=bool) if cut_at else r < c
                unsure = unsure[keep[unsure]]
                keep[unsure] = _cosine(m, square, r[unsure], c[unsure]) >= threshold
                i, j = ids[r[keep]], ids[c[keep]]
                i, j = np.minimum(i, j), np.maximum(i, j)
                if (apart := i < j).any():
                    yield i[apart], j[apart]


def _tiles(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Edges of tiles from rows sorted by tile and block. One tile's vectors are held, never its similarities."""

    def done(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held)
        a, b = t.column("a")[0].as_py(), t.column("b")[0].as_py()
        first = int(np.searchsorted(t.column("block").to_numpy(), b)) if a < b else 0
        if a < b and first in (0, t.num_rows):
            return
        m = t.column("embedding").combine_chunks()
        m = m.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(t.num_rows, -1)
        i, j, size = [], [], 0
        for x, y in _near(t.column("vec_id").to_numpy(), m, first, threshold):
            i.append(x)
            j.append(y)
            size += len(x)
            if size >= EDGES:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(i)), pa.array(np.concatenate(j))], names=["i", "j"])
                i, j, size = [], [], 0
        if size:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(i)), pa.array(np.concatenate(j))], names=["i", "j"])

    held: list[pa.RecordBatch] = []
    for batch in batches:
        tile = np.stack([batch.column(k).to_numpy() for k in ("a", "b")])
        starts = np.flatnonzero((tile[:, 1:] != tile[:, :-1]).any(axis=0)) + 1
        for s, e in zip([0, *starts], [*starts, batch.num_rows]):
            if s == e:
                continue
            if held and (held[-1].column("a")[0].as_py(), held[-1].column("b")[0].as_py()) != tuple(tile[:, s]):
                yield from done(held)
                held = []
            held.append(batch.slice(s, e - s))
    if held:
        yield from done(held)


def cosine_edges(vectors: DataFrame, threshold: float, blocks: int | None = None) -> DataFrame:
    """``i, j`` (i < j) of pairs at the threshold. Each pair of blocks is one tile; a block is a hash class of ids.

    A tile is done by one task in memory that does not grow with the table; there are as many blocks as that takes, and
    enough for all cores. The number of tiles grows with the square of the table, as pairs do.
    """
    vectors = vectors.select("vec_id", "embedding").where("vec_id IS NOT NULL AND embedding IS NOT NULL")
    if blocks is None:
        n, width = vectors.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
        cores = vectors.sparkSession.sparkContext.defaultParallelism
        blocks = max(-(-n * max(width or 1, 1) // BLOCK_NUMBERS), int(2 * cores**0.5) + 1)
    mine = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda k: F.struct(F.least(k, mine).alias("a"), F.greatest(k, mine).alias("b")))
    dealt = vectors.select("vec_id", "embedding", mine.alias("block"), F.explode(pairs).alias("p")).select("vec_id", "embedding", "block", "p.a", "p.b")
    placed = dealt.repartition(blocks * (blocks + 1) // 2, "a", "b").sortWithinPartitions("a", "b", "block")
    return placed.mapInArrow(lambda it: _tiles(it, threshold), "i long, j long")


def leaders(ids: DataFrame, edges: DataFrame) -> DataFrame:
    """``vec_id, leader``: in ascending order, each unclaimed id claims its later unclaimed neighbours.

    Found as a fixpoint: an id leads once all smaller neighbours are claimed; its neighbours are claimed by the least
    leader next to them.
    """
    edges = cut(edges)
    open_ = cut(ids.select("vec_id"))
    done = None
    while not open_.isEmpty():
        blocked = edges.select(F.col("j").alias("vec_id")).distinct()
        lead = cut(open_.join(blocked, "vec_id", "left_anti"))
        claimed = edges.join(lead.withColumnRenamed("vec_id", "i"), "i", "left_semi").groupBy(F.col("j").alias("vec_id")).agg(F.min("i").alias("leader"))
        got = cut(lead.select("vec_id", F.col("vec_id").alias("leader")).unionByName(claimed))
        open_ = cut(open_.join(got, "vec_id", "left_anti"))
        # Only edges between open ids are read again; each round leaves fewer of them.
        edges = cut(edges.join(open_.withColumnRenamed("vec_id", "i"), "i", "left_semi").join(open_.withColumnRenamed("vec_id", "j"), "j", "left_semi"))
        done = got if done is None else done.unionByName(got)
    return done if done is not None else ids.select("vec_id", F.col("vec_id").alias("leader"))


def singletons(ids: DataFrame, edges: DataFrame) -> DataFrame:
    """Ids that are alone in their group; leaders of larger groups do not stay, unlike with ``leaders``."""
    return leaders(ids, edges).groupBy("leader").agg(F.count(F.lit(1)).alias("n")).where("n = 1").select(F.col("leader").alias("vec_id"))
