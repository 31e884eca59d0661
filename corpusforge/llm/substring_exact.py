"""Removal of repeated byte strings by a distributed suffix array.

Every byte covered by a string of ``length`` bytes that also starts anywhere else goes. The texts are parsed into
phrases at anchors, places whose next ``context`` bytes have a certain hash, so that equal strings are parsed alike.
A phrase reaches from an anchor to the end of the next one's context; phrases whose content occurs once cannot lie in
a repeat. The suffixes of what is left, as strings of phrases, are sorted by a difference cover, and adjacent
suffixes are compared over the prefix that covers every string starting in their first phrase. Where these agree, all
such strings are repeated, and one suffix of the group stands for the others. Strings at the ends of repeats, which
only agree in the phrases inside them, and strings with fewer than two anchors are settled by comparing the strings
themselves, with each other and with those that groups stand for.

Phrases, prefixes and strings are compared by 64-bit hashes, and texts by a 64-bit hash and their length in bytes.

Defined cases: a null text is empty and loses nothing; repeated rows and copies repeat each other and lose all their
bytes if they have ``length`` or more; very long texts are parsed as any other; an empty table gives no rows. Columns
other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusforge.llm.common import Scratch, cut, release
from corpusforge.llm.kernels import U, mix, prefix_hash, signed, slice_hash, steps
from corpusforge.llm.suffixes import suffix_ranks


@dataclass(frozen=True)
class RepeatConfig:
    length: int = 400
    context: int = 16
    #: One place in so many is an anchor, about.
    spacing: int = 48
    #: Bytes of per-text results that may be broadcast; beyond, texts are shuffled to them.
    broadcast_bytes: int = 64_000_000


class Parsed:
    """Anchors, phrases and prefixes of a run of texts that are joined by single bytes in one buffer."""

    def __init__(self, run: list[bytes], c: RepeatConfig):
        self.buf = np.frombuffer(b"\n".join(run) + b"\n", dtype=np.uint8)
        self.sums = prefix_hash(self.buf)
        self.start = np.cumsum([0] + [len(b) + 1 for b in run])
        self.c = c
        last = len(self.buf) - c.context
        places = np.arange(max(last, 0))
        h = mix(slice_hash(self.sums, places, places + c.context), 11) % U(c.spacing) == 0
        places = places[h]
        owner = np.searchsorted(self.start, places, side="right") - 1
        inside = places + c.context < self.start[owner + 1]
        self.places, self.owner = places[inside], owner[inside]
        self.first = np.searchsorted(self.owner, np.arange(len(run) + 1))

    def phrases(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends (in the buffer) of the phrases of text ``i``."""
        a = self.places[self.first[i] : self.first[i + 1]]
        return a[:-1], a[1:] + self.c.context

    def names(self, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        return mix(slice_hash(self.sums, s, e) + (e - s).astype(U) * U(0x9E3779B97F4A7C15))

    def needs(self, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        """Phrases from each on that cover every string starting in it; one more than there are if the text ends."""
        nxt = e - self.c.context
        return np.searchsorted(e, nxt + self.c.length - 1) - np.arange(len(s)) + 1


def _phrases(batches: Iterator[pa.RecordBatch], c: RepeatConfig) -> Iterator[pa.RecordBatch]:
    names = ["name", "sid", "k", "need", "head", "at", "next", "before", "beyond"]
    for b in batches:
        sid = b.column("sid").to_numpy(zero_copy_only=False)
        for first, run in steps(b.column("text").to_pylist()):
            p = Parsed(run, c)
            out: list[list[np.ndarray]] = [[] for _ in names]
            for i in range(len(run)):
                s, e = p.phrases(i)
                if not len(s) or len(run[i]) < c.length:
                    continue
                need = p.needs(s, e)
                k = np.arange(len(s))
                full = k + need <= len(s)
                head = p.names(s, e[np.minimum(k + need, len(s)) - 1])
                head[~full] = 0
                s0, e0 = s - p.start[i], e - p.start[i]
                before, beyond = np.concatenate([[0], s0[:-1]]), np.concatenate([e0[1:], [len(run[i])]])
                for col, v in zip(out, (p.names(s, e), np.full(len(s), sid[first + i]), k, np.where(full, need, 1 << 30), head, s0, e0 - c.context, before, beyond), strict=True):
                    col.append(v)
            if out[0]:
                cols = [np.concatenate(v) for v in out]
                arrays = [signed(cols[0]), pa.array(cols[1]), *(pa.array(x.astype(np.int32)) for x in cols[2:4]), signed(cols[4]), *(pa.array(x.astype(np.int32)) for x in cols[5:])]
                whole = pa.RecordBatch.from_arrays(arrays, names=names)
                for j in range(0, whole.num_rows, 100_000):
                    yield whole.slice(j, 100_000)


def _adjacent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whether each suffix of a sorted partition has the prefix of the one before it, or of the one after it."""
    held: pa.RecordBatch | None = None
    last = None

    def mark(b: pa.RecordBatch, before, after) -> pa.RecordBatch:
        h = b.column("head").to_numpy()
        ok = b.column("whole").to_numpy(zero_copy_only=False)
        same = (h[1:] == h[:-1]) & ok[1:] & ok[:-1]
        back = np.concatenate([[before is not None and ok[0] and before == h[0]], same])
        fore = np.concatenate([same, [after is not None and ok[-1] and after == h[-1]]])
        return pa.RecordBatch.from_arrays([*(b.column(x) for x in ("sid", "k")), pa.array(np.where(back, 2, np.where(fore, 1, 0)).astype(np.int32))], names=["sid", "k", "status"])

    for b in batches:
        if not b.num_rows:
            continue
        if held is not None:
            yield mark(held, last, b.column("head")[0].as_py() if b.column("whole")[0].as_py() else None)
            last = held.column("head")[-1].as_py() if held.column("whole")[-1].as_py() else None
        held = b
    if held is not None:
        yield mark(held, last, None)


def _open_places(s: np.ndarray, e: np.ndarray, live: np.ndarray, size: int, length: int) -> np.ndarray:
    """Places where a string may start all of whose phrases occur again, or that has no phrase inside.

    Around each run of live phrases, such strings lie between the start of the phrase before and the end of the one
    after; strings without a phrase lie between one phrase's start and the next one's end.
    """
    froms = np.concatenate([[0], s])  # of the phrase before phrase k
    tos = np.concatenate([e, [size]])  # of phrase k, and the text
    void = np.flatnonzero(tos - froms > length)
    edge = np.diff(live.astype(np.int8), prepend=0, append=0)
    first, after = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    lo, hi = np.concatenate([froms[void], froms[first]]), np.concatenate([tos[void], tos[after]])
    wide = hi - lo >= length
    d = np.zeros(max(size - length + 2, 1), dtype=np.int32)
    np.add.at(d, lo[wide], 1)
    np.add.at(d, hi[wide] - length + 1, -1)
    return np.flatnonzero(np.cumsum(d)[: size - length + 1] > 0)


def _hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places (not groups' strings) whose hash has another row next to it in a sorted partition, and settled runs."""
    held = last = None

    def pick(b: pa.RecordBatch, before, after):
        h = b.column("h").to_numpy()
        same = h[1:] == h[:-1]
        hit = np.concatenate([[before is not None and before == h[0]], same]) | np.concatenate([same, [after is not None and after == h[-1]]])
        at, sid = b.column("at").to_numpy().astype(np.int64), b.column("sid").to_numpy()
        hit = hit & (at >= 0) | (at < -1)
        at, sid = at[hit], sid[hit]
        start = np.where(at < 0, -2 - at, at)
        end = start + np.where(at < 0, h[hit] & 0xFFFFFFFF, 1)
        return pa.RecordBatch.from_arrays([pa.array(sid), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32))], names=["sid", "at", "next"])

    for b in batches:
        if not b.num_rows:
            continue
        if held is not None:
            yield pick(held, last, b.column("h")[0].as_py())
            last = held.column("h")[-1].as_py()
        held = b
    if held is not None:
        yield pick(held, last, None)


def _settle(h: np.ndarray, sid: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Settles the strings that occur again in the step at hand, so that a frequent one is sent on once a step.

    The places of such strings become runs: ``at`` is ``-2 - place``, and the low half of a scattered ``h`` holds the
    length. One row stands for each string.
    """
    values, inv, n = np.unique(h, return_inverse=True, return_counts=True)
    again = n[inv.ravel()] > 1
    places = again & (at >= 0)
    s, a = sid[places], at[places].astype(np.int64)
    first = np.flatnonzero(np.diff(s, prepend=s[:1] + 1).astype(bool) | (np.diff(a, prepend=-1) != 1))
    length = np.diff(np.append(first, len(s)))
    s, a = s[first], a[first]
    scattered = mix(s.view(U) + mix(a.astype(U)), 6) & ~U(0xFFFFFFFF) | length.astype(U)
    stand = values[n > 1]
    return (
        np.concatenate([h[~again], stand, scattered]),
        np.concatenate([sid[~again], np.zeros(len(stand), dtype=np.int64), s]),
        np.concatenate([at[~again], np.full(len(stand), -1), -2 - a]).astype(np.int32),
    )


def _strings(batches: Iterator[pa.RecordBatch], c: RepeatConfig) -> Iterator[pa.RecordBatch]:
    """Hashes of the strings that prefixes could not settle, by place, and of those that groups stand for.

    ``_live`` lists a text's phrases that occur again, ``_status`` what their prefixes showed (0: nothing, 1: repeated
    and standing for a group, 2: repeated and stood for).
    """
    for b in batches:
        sid = b.column("sid").to_numpy(zero_copy_only=False)
        lives, states = b.column("_live"), b.column("_status")
        for first, run in steps(b.column("text").to_pylist()):
            p = Parsed(run, c)
            hs, ids, at = [], [], []
            for i in range(len(run)):
                n = len(run[i]) - c.length + 1
                if n <= 0:
                    continue
                base = p.start[i]
                s, e = p.phrases(i)
                s, e = s - base, e - base
                state = np.full(len(s), -1, dtype=np.int64)  # -1: occurs once
                if lives[first + i].is_valid:
                    state[lives[first + i].values.to_numpy()] = states[first + i].values.to_numpy()
                w = _open_places(s, e, state >= 0, len(run[i]), c.length)
                if not len(w):
                    continue
                lo = np.searchsorted(s, w)  # the phrases inside the string are lo to hi - 1
                hi = np.searchsorted(e, w + c.length, side="right")
                dead = np.concatenate([[0], np.cumsum(state < 0)])
                hi = np.maximum(hi, lo)
                open_ = dead[hi] == dead[lo]
                own = np.searchsorted(s, w, side="right") - 1  # the phrase in which the string starts, if any
                inside = (own >= 0) & (w < (e - c.context)[np.maximum(own, 0)]) if len(s) else np.zeros(len(w), dtype=bool)
                status = np.where(inside, state[np.maximum(own, 0)] if len(s) else 0, 0)
                for want, known in ((open_ & (status <= 0), True), (open_ & (status == 1), False)):
                    w1 = w[want]
                    if len(w1):
                        hs.append(mix(slice_hash(p.sums, w1 + base, w1 + base + c.length), 5))
                        at.append(w1 if known else np.full(len(w1), -1))
                        ids.append(np.full(len(w1), sid[first + i] if known else 0))
            if hs:
                h, d, a = _settle(np.concatenate(hs), np.concatenate(ids), np.concatenate(at).astype(np.int32))
                for j in range(0, len(h), 100_000):
                    yield pa.RecordBatch.from_arrays([signed(h[j : j + 100_000]), pa.array(d[j : j + 100_000]), pa.array(a[j : j + 100_000])], names=["h", "sid", "at"])


def _join_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's ranges of places, merged into runs."""

    def lists(parts: list[np.ndarray]) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.cumsum([0] + [len(x) for x in parts]), pa.int32()), pa.array(np.concatenate(parts), pa.int32()))

    for b in batches:
        froms, tos = [], []
        for x, y in zip(b.column("_from"), b.column("_to"), strict=True):
            s, e = x.values.to_numpy(), y.values.to_numpy()
            order = np.argsort(s, kind="stable")
            s, e = s[order], np.maximum.accumulate(e[order])
            start = np.concatenate([[0], np.flatnonzero(s[1:] > e[:-1]) + 1])
            froms.append(s[start])
            tos.append(e[np.append(start[1:], len(s)) - 1])
        if froms:
            yield pa.RecordBatch.from_arrays([b.column("_sid"), lists(froms), lists(tos)], names=["_sid", "_from", "_to"])


def _remove(batches: Iterator[pa.RecordBatch], c: RepeatConfig, with_text: bool) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = b.column("text").to_pylist()
        ranges = [b.column(x) for x in ("_from", "_to")]
        copies = b.column("_copies").to_pylist()
        total, removed, spans, digest, rest_text = [], [], [], [], []
        for i, t in enumerate(texts):
            raw = t.encode("utf-8", "surrogatepass") if t else b""
            n = len(raw)
            cut_, runs, rest = 0, 0, raw
            if n >= c.length and (copies[i] or 1) > 1:
                cut_, runs, rest = n, 1, b""
            elif ranges[0][i].is_valid:
                s, e = (x[i].values.to_numpy().astype(np.int64) for x in ranges)
                e = np.minimum(e, n - c.length + 1)
                s, e = s[s < e], e[s < e]
                d = np.zeros(n + 1, dtype=np.int64)
                np.add.at(d, s, 1)
                np.add.at(d, e - 1 + c.length, -1)
                gone = np.cumsum(d)[:n] > 0
                cut_ = int(gone.sum())
                runs = int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))
                rest = np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes()
            total.append(n)
            removed.append(cut_)
            spans.append(runs)
            digest.append(hashlib.sha256(rest).hexdigest())
            rest_text.append(rest if with_text else None)
        cols = [b.column("doc_id"), *(pa.array(v, pa.int64()) for v in (total, removed, spans)), pa.array(digest, pa.string())]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        if with_text:
            cols.append(pa.array(rest_text, pa.binary()))
            names.append("kept")
        yield pa.RecordBatch.from_arrays(cols, names=names)


def _attach(texts: DataFrame, table: DataFrame, total: int, c: RepeatConfig) -> DataFrame:
    """Texts with their row of ``table`` (``_sid``), which is broadcast if its measured size allows."""
    return texts.join(F.broadcast(table) if total <= c.broadcast_bytes else table, F.col("sid") == F.col("_sid"), "left")


def remove_repeats(docs: DataFrame, config: RepeatConfig = RepeatConfig(), with_text: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row, and with ``with_text`` the ``kept`` bytes."""
    c, spark = config, docs.sparkSession
    tmp = Scratch(spark)
    texts = docs.select("doc_id", "text", F.xxhash64(F.octet_length("text"), F.col("text")).alias("sid"))
    copies = cut(texts.groupBy("sid").agg(F.count(F.lit(1)).alias("_copies")).where("_copies > 1"))

    live = texts.select("sid", "text").mapInArrow(lambda it: _phrases(it, c), "name long, sid long, k int, need int, head long, at int, next int, before int, beyond int")
    live = live.repartition("name").dropDuplicates(["name", "sid", "k"])  # a copy's phrases count once
    live = live.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("name"))).where("n > 1").drop("n")
    # A run of live phrases with the phrases before and after it must have room for a string.
    run = Window.partitionBy("sid").orderBy("k")
    of_run = Window.partitionBy("sid", "lane")
    live = live.withColumn("lane", (F.col("k") - F.row_number().over(run) + 1).cast("long"))
    live = live.withColumn("room", F.max("beyond").over(of_run) - F.min("before").over(of_run)).where(F.col("room") >= c.length).drop("room", "before", "beyond")
    live = tmp.keep(live, "live")
    release(spark)
    runs = live.withColumn("whole", F.col("need") <= F.max("k").over(of_run) - F.col("k") + 1)
    # A run too short to cover any string has nothing to sort.
    runs = runs.withColumn("some", F.max("whole").over(of_run)).withColumn("j", (F.col("k") - F.min("k").over(of_run)).cast("long")).where("some").drop("some")
    runs = tmp.keep(runs, "runs")
    need = runs.where("whole").agg(F.max("need")).first()[0] or 1
    ranks = suffix_ranks(runs.select("sid", "lane", "j", "name"), need, tmp)
    order = runs.join(ranks, ["sid", "lane", "j"]).repartitionByRange("rank").sortWithinPartitions("rank", "head")
    status = tmp.keep(order.select("sid", "k", "head", "whole").mapInArrow(_adjacent, "sid long, k int, status int"), "status")
    tmp.drop("runs", "ranks-1")

    known = live.select("sid", "k", "name", "at", "next").join(status, ["sid", "k"], "left").withColumn("status", F.coalesce("status", F.lit(0)))
    # A group's strings are only asked for if some string that is not settled has their first whole phrase; phrases
    # so long that a string may hold none (or only that in which it starts) are always asked for.
    near = Window.partitionBy("sid").orderBy("k")

    def beside(k: int, name: str):
        return F.when(F.lead("k", k).over(near) == F.col("k") + k, F.lead(name, k).over(near))

    known = tmp.keep(known.select("*", beside(1, "name").alias("then"), beside(1, "next").alias("beyond"), beside(-1, "status").alias("ahead")), "known")
    tmp.drop("live", "status")
    asked = known.where("ahead IS NULL").select(F.col("name").alias("_n")).unionByName(known.where("status = 0 AND then IS NOT NULL").select(F.col("then").alias("_n"))).distinct()
    asked = tmp.keep(asked, "asked")
    short = F.col("beyond") + c.context - F.col("at") <= c.length
    silent = F.when((F.col("status") == 1) & F.col("then").isNotNull() & short & F.col("_n").isNull(), 2).otherwise(F.col("status"))
    told = known.join(asked, F.col("then") == F.col("_n"), "left").select("sid", "k", silent.alias("status"))
    per_text = tmp.keep(told.groupBy(F.col("sid").alias("_sid")).agg(F.array_sort(F.collect_list(F.struct("k", "status"))).alias("x")).select("_sid", F.col("x.k").alias("_live"), F.col("x.status").alias("_status")), "per_text")
    size = (per_text.agg(F.sum(F.size("_live") * 8 + 64)).first()[0] or 0)
    ask = _attach(texts.select("sid", "text"), per_text, size, c).select("sid", "text", "_live", "_status")
    strings = ask.mapInArrow(lambda it: _strings(it, c), "h long, sid long, at int")
    # A string is repeated if its hash has another place, or a group that it stands for.
    hits = strings.repartition("h").sortWithinPartitions("h").mapInArrow(_hits, "sid long, at int, next int")
    ranges = known.where("status > 0").select("sid", "at", "next").unionByName(hits)
    ranges = ranges.groupBy(F.col("sid").alias("_sid")).agg(F.collect_list("at").alias("_from"), F.collect_list("next").alias("_to"))
    ranges = tmp.keep(ranges.mapInArrow(_join_up, "_sid long, _from array<int>, _to array<int>"), "ranges")
    tmp.drop("per_text", "known", "asked")
    size = (ranges.agg(F.sum(F.size("_from") * 8 + 64)).first()[0] or 0)
    many = copies.select(F.col("sid").alias("_of"), "_copies")
    out = _attach(texts, ranges, size, c)
    out = out.join(F.broadcast(many) if many.count() <= 200_000 else many, F.col("sid") == F.col("_of"), "left").select("doc_id", "text", "_from", "_to", "_copies")
    return out.mapInArrow(lambda it: _remove(it, c, with_text), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_text else ""))
