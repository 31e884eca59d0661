"""Likeness of each text and the next one of its group, in one pass over sorted rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusforge.checkpoint import cut, lean_batches


def _numbered(parts: list[np.ndarray]) -> list[np.ndarray]:
    """Values of all parts as their ranks, equal ones alike."""
    ranks = np.unique(np.concatenate(parts), return_inverse=True)[1].ravel().astype(np.uint64)
    return np.split(ranks, np.cumsum([len(p) for p in parts[:-1]]))


def gram_jaccard(a: str, b: str, n: int) -> float:
    """Jaccard similarity of the sets of ``n``-grams of code points; a text shorter than ``n`` is its own only gram.

    Grams are numbered exactly: letters by rank, as many as fit 64 bits at once; longer grams by pairs of ranks.
    """
    if len(a) < n or len(b) < n:
        same = a == b
        sizes = [1 if len(t) < n else len({t[i : i + n] for i in range(len(t) - n + 1)}) for t in (a, b)]
        return same / (sum(sizes) - same)
    letters = _numbered([np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype=np.uint32) for t in (a, b)])
    width = max(int(max(r.max() for r in letters)).bit_length(), 1)
    codes = None
    for start in range(0, n, 64 // width):
        run = []
        for r in letters:
            code = np.zeros(len(r) - n + 1, dtype=np.uint64)
            for k in range(start, min(start + 64 // width, n)):
                code = (code << np.uint64(width)) | r[k : k + len(code)]
            run.append(code)
        codes = run if codes is None else [(p << np.uint64(32)) | q for p, q in zip(_numbered(codes), _numbered(run), strict=True)]
    x, y = (np.unique(c) for c in codes)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both)


def _run(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """Rows of sorted texts with their likeness to the next row; the partition's ends come with their text (``end`` 0
    for the first, 1 for the last), as the last row's next one lies in another partition."""
    kind, pid = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.string(), pa.float64()], TaskContext.get().partitionId()

    def made(rows: list[tuple]) -> pa.RecordBatch:
        cols = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kind, strict=True)], names=["end", "pid", "k", "doc_id", "text", "jaccard"])

    last = None
    for b in batches:
        rows = []
        for now in zip(*(b.column(c) for c in ("k", "doc_id", "text")), strict=True):
            now = tuple(v.as_py() for v in now)
            if last is None:
                yield made([(0, pid, *now, None)])
            elif last[0] == now[0] and now[2] is not None:
                rows.append((None, pid, None, last[1], None, None if last[2] is None else gram_jaccard(last[2], now[2], n)))
            last = now
        if rows:
            yield made(rows)
    if last is not None:
        yield made([(1, pid, *last, None)])


def next_jaccard(docs: DataFrame, key: str, n: int = 8) -> DataFrame:
    """``doc_id, jaccard`` of each text and the next one of its ``key`` by ``doc_id``; a last text has no row.

    Texts are shuffled once, into ranges; only the texts at the ranges' ends move again.
    """
    lean_batches(docs.sparkSession)
    order = ["k", F.col("doc_id").asc_nulls_last()]
    ranged = docs.select(F.col(key).alias("k"), "doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order)
    made = cut(ranged.mapInArrow(lambda it: _run(it, n), "end int, pid int, k string, doc_id long, text string, jaccard double"))
    follow = Window.partitionBy("k").orderBy("pid", "end")
    ends = made.where("end IS NOT NULL").select("end", "doc_id", F.col("text").alias("a"), F.lead("text").over(follow).alias("b")).where("end = 1 AND b IS NOT NULL")

    def likeness(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            pairs = zip(t.column("a").to_pylist(), t.column("b").to_pylist(), strict=True)
            yield pa.RecordBatch.from_arrays([t.column("doc_id"), pa.array([None if a is None else gram_jaccard(a, b, n) for a, b in pairs], pa.float64())], names=["doc_id", "jaccard"])

    return made.where("end IS NULL").select("doc_id", "jaccard").unionByName(ends.select("doc_id", "a", "b").mapInArrow(likeness, "doc_id long, jaccard double"))
