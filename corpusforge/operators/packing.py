"""Chunks, tokens and blocks of fixed length."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from corpusforge.checkpoint import cut, lean_batches


def arranged(docs: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The rows in ranges of keys and order, sorted. What is computed of them afterwards, row by row, stays so."""
    return docs.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)


def _runs(batch: pa.RecordBatch, keys: list[str], last: tuple | None) -> tuple[list[int], bool]:
    """Where runs of equal keys start in a batch, plus its end, and whether its first run goes on with ``last``."""
    change = np.zeros(batch.num_rows - 1, dtype=bool)
    for k in keys:
        a, b = batch.column(k).slice(0, len(change)), batch.column(k).slice(1)
        change |= pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False) | (a.is_null().to_numpy(zero_copy_only=False) != b.is_null().to_numpy(zero_copy_only=False))
    return [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows], last == tuple(batch.column(k)[0].as_py() for k in keys)


def _ends(batches: Iterator[pa.RecordBatch], keys: list[str], size: int) -> Iterator[pa.RecordBatch]:
    """One row of a partition: its first and last key, how many tokens these have in it, whether they are one, and how
    many rows hold the first ``size`` tokens of the first key."""
    first = last = pid = None
    heads, tokens, head = 0, [0, 0], 0
    for b in batches:
        if not b.num_rows:
            continue
        n = b.column("_n").to_numpy()
        starts, same = _runs(b, keys, last[1] if last else None)
        if first is None:
            first, pid, same, heads = b.slice(0, 1), b.column("_pid")[0].as_py(), True, 1
        for s, e in zip(starts, starts[1:]):
            if s or not same:
                heads, tokens[1] = heads + 1, 0
            if heads == 1:
                before = tokens[0] + np.cumsum(n[s:e]) - n[s:e]
                head += int(np.count_nonzero(before < size))
                tokens[0] += int(n[s:e].sum())
            tokens[1] += int(n[s:e].sum())
        last = b.slice(b.num_rows - 1), tuple(b.column(k)[-1].as_py() for k in keys)
    if first is not None:
        cols = [pa.array([pid], pa.int32()), *(pa.array([v]) for v in (tokens[0], tokens[1], heads == 1, head))]
        edge = [x.column(k) for x in (first, last[0]) for k in keys]
        yield pa.RecordBatch.from_arrays([*cols, *edge], names=["pid", "n_first", "n_last", "one", "head", *(f"{x}{i}" for x in "fl" for i in range(len(keys)))])


def _chop(batches: Iterator[pa.RecordBatch], keys: list[str], size: int, ahead: dict[int, int], follow: dict[int, pa.Array]) -> Iterator[pa.RecordBatch]:
    """Full blocks that begin in a partition: ``ahead`` are tokens of its first key before it, ``follow`` those after it
    of its last key, as many as one block may need."""
    pid = last = None
    rest: list[pa.Array] = []
    at = held = skip = 0

    def blocks(of: pa.RecordBatch, row: int) -> Iterator[pa.RecordBatch]:
        nonlocal rest, held, at
        m = held // size
        if m:
            flat = pa.concat_arrays(rest)
            values = pa.ListArray.from_arrays(pa.array(np.arange(0, m * size + 1, size, dtype=np.int32)), flat.slice(0, m * size))
            key = [of.column(k).take(pa.array(np.full(m, row))) for k in keys]
            yield pa.RecordBatch.from_arrays([*key, pa.array(np.arange(at // size, at // size + m)), values], names=[*keys, "block", "tokens"])
            rest, held, at = [flat.slice(m * size)], held - m * size, at + m * size

    for b in batches:
        if not b.num_rows:
            continue
        starts, same = _runs(b, keys, last[1] if last else None)
        if pid is None:
            pid = b.column("_pid")[0].as_py()
            at = ahead.get(pid, 0)
            skip, same = -at % size, True
            at += skip
        lists = b.column("_tokens")
        if not pa.types.is_list(lists.type):
            lists = pc.split_pattern(lists, " ")
        offsets, flat = lists.offsets.to_numpy(), lists.values
        out = []
        for s, e in zip(starts, starts[1:]):
            if s or not same:
                rest, at, held, skip = [], 0, 0, 0
            part = flat.slice(offsets[s], offsets[e] - offsets[s])
            if skip:
                gone = min(skip, len(part))
                part, skip = part.slice(gone), skip - gone
            rest.append(part)
            held += len(part)
            out += blocks(b, s)
        last = b.slice(b.num_rows - 1), tuple(b.column(k)[-1].as_py() for k in keys)
        if out:
            yield from pa.Table.from_batches(out).combine_chunks().to_batches()
    if held and pid in follow:
        more = follow[pid].slice(0, size - held)
        rest.append(more.cast(rest[0].type))
        held += len(more)
        yield from blocks(last[0], 0)


def pack(docs: DataFrame, tokens: Column, size: int, keys: list[str], order: list[str], is_arranged: bool = False, words: bool = False) -> DataFrame:
    """``*keys, block, tokens``: the tokens of all documents of a key in order, cut into full blocks of ``size``.

    What does not fill a block is dropped. Rows are shuffled once, before their tokens are computed, unless they are
    ``arranged`` by keys and order already; a partition then gives all blocks that begin in it. The ends of partitions,
    one row and at most two blocks of tokens each, pass the driver. ``words`` says that tokens are strings that hold no
    blank and are not empty: they are kept as one string, which takes less than half the disk of an array.
    """
    spark = docs.sparkSession
    lean_batches(spark)
    rows = docs if is_arranged else arranged(docs, keys, order)
    kept = F.nullif(F.array_join(tokens, " "), F.lit("")) if words else F.coalesce(tokens, F.array())
    sized = rows.select(*keys, kept.alias("_tokens"), F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_row"))
    held = cut(sized)
    kinds = [held.schema[k].dataType.simpleString() for k in keys]
    edge = "".join(f", {x}{i} {t}" for x in "fl" for i, t in enumerate(kinds))
    t = F.col("_tokens")
    listed = F.split(t, " ") if words else t
    many = F.coalesce(F.octet_length(t) - F.octet_length(F.replace(t, F.lit(" "), F.lit(""))) + 1, F.lit(0)) if words else F.size(t)
    ends = held.select(*keys, "_pid", many.cast("long").alias("_n")).mapInArrow(lambda it: _ends(it, keys, size), f"pid int, n_first long, n_last long, one boolean, head long{edge}")
    ends = sorted(ends.collect(), key=lambda r: r["pid"])
    ahead, goes_on = {}, set()
    for before, r in zip(ends, ends[1:]):
        if all(before[f"l{i}"] == r[f"f{i}"] for i in range(len(keys))):
            goes_on.add(r["pid"])
            ahead[r["pid"]] = before["n_last"] + (ahead.get(before["pid"], 0) if before["one"] else 0)
    heads: dict[int, list[pa.Array]] = {}
    if goes_on:
        asked = spark.createDataFrame([(r["pid"], r["head"]) for r in ends if r["pid"] in goes_on], "_p int, _head long")
        place = F.col("_row").bitwiseAND((1 << 33) - 1)
        first = held.join(F.broadcast(asked), F.col("_pid") == F.col("_p")).where(place < F.col("_head")).select("_pid", "_row", F.coalesce(F.slice(listed, 1, size), F.array()).alias("_tokens"))
        got = first.orderBy("_pid", "_row").toArrow().combine_chunks()
        for b in got.to_batches():
            for i, p in enumerate(b.column("_pid").to_pylist()):
                heads.setdefault(p, []).append(b.column("_tokens")[i].values)
    follow = {}
    for i, r in enumerate(ends):
        parts, n = [], 0
        for later in ends[i + 1 :]:
            if later["pid"] not in goes_on or n >= size:
                break
            parts += heads.get(later["pid"], [])
            n = sum(map(len, parts))
            if not later["one"]:
                break
        if n:
            follow[r["pid"]] = pa.concat_arrays(parts).slice(0, size)
    border = spark.sparkContext.broadcast((ahead, follow))
    made = StructType([held.schema[k] for k in keys]).add("block", LongType()).add("tokens", ArrayType(StringType()) if words else held.schema["_tokens"].dataType)
    return held.select(*keys, "_tokens", "_pid").mapInArrow(lambda it: _chop(it, keys, size, *border.value), made)


def checked_cast(value: Column, bits: int) -> Column:
    """An id as an unsigned integer of ``bits``; an id that does not fit is an error."""
    return F.when((value < 0) | (value >= 1 << bits), F.raise_error(F.concat(F.lit(f"id does not fit {bits} bits: "), value.cast("string")))).otherwise(value)
