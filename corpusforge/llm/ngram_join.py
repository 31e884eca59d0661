"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix.

1. Documents with equal shingle sets form classes; one member stands for each.
2. A document at Jaccard ``t`` with another shares at least ``ceil(t * size)`` of its shingles, so it shares one of
   any ``size - ceil(t * size) + 1`` of them. Taking these first in one global order, frequent shingles last and the
   rest by hash, puts every pair that can link into a common bucket. How many buckets two classes share bounds their
   overlap from above; pairs below the bound that their sizes ask for are discarded. First, classes are only counted
   against the least class of each bucket, and those that share half of what is asked for make up provisional
   diagonal blocks of the product. Then the pairs across these blocks, few by now, are counted in full, and those at
   the bound join their blocks. A bucket's pairs number its seats times those outside of its main block; where that is
   too many, for the bucket or for all of them, nothing is counted, and the bucket's classes are a further block of
   their own. Blocks that only meet in such a bucket stay apart: joined, they would grow into one that takes much of
   the table. No pair that can link is left outside of a block: it meets in a crowded bucket, or all its buckets count.
3. A block too large for one task is dealt into sub-blocks, and each pair of these is a unit of its own.
4. Within a unit, the overlap counts of a row with all others accumulate over its n-gram columns, rarest first. Rows
   below the size bounds, or that share none of the columns that must be shared, are discarded; exact counts decide
   the rest. A row that has linked leaves the product, since only connections matter, so that a large group of near
   copies costs a few rows and no pairs are emitted.
5. The links found (one per row at most in a unit) give components.

The order in step 2 only affects how much work there is: any set of frequent shingles gives the same result.

Defined cases: a null or empty text, or one without words, has an empty set and is linked with nothing, its
component is its own doc_id. With fewer words than a shingle, the whole sequence is the shingle. Equal texts link.
Repeated rows are equal texts; null doc_ids are never the smallest unless a component has no other. Other columns
are not read by ``link_documents`` and are kept by ``keep_one``. Shingles and sets are compared by 64 and 128 bit
hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.llm.common import Scratch, cut, packed, release, unpacked, words
from corpusforge.llm.kernels import U, bounds, grouped, mix, shingle_sets, signed
from corpusforge.operators.components import components


@dataclass(frozen=True)
class JoinConfig:
    n: int = 5
    percent: int = 75
    #: Shingles that occur this often within one input split are candidates for the end of the order.
    frequent_in_split: int = 2
    #: Most shingles in the list of frequent ones, which is broadcast. It must hold those that texts share by chance, or
    #: their buckets join blocks that have nothing else in common.
    frequent_list: int = 2_000_000
    #: Seats of a bucket up to which its pairs across blocks are always counted one by one; the pairs of larger buckets
    #: are, smallest first, up to so many for each seat of all, and so many in a bucket.
    pair_bucket: int = 64
    pairs_per_seat: int = 1
    pairs_in_bucket: int = 1 << 20
    #: Shingles (with repeats across documents) that one unit of the product holds.
    unit_shingles: int = 2_000_000


def _must_share(size: np.ndarray | int, percent: int):
    return (percent * size + 99) // 100


def _sets(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sizes, one, two = [], [], []
        for s in shingle_sets(b.column("text").to_pylist(), n):
            sizes.append(len(s))
            one.append(mix(s, 1).sum(dtype=U))
            two.append(mix(s, 2).sum(dtype=U))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("_row"), pa.array(sizes, pa.int64()), signed(np.array(one, dtype=U)), signed(np.array(two, dtype=U))], names=["doc_id", "_row", "n_shingles", "k1", "k2"])


def _first(s: np.ndarray, c: JoinConfig, frequent: np.ndarray) -> np.ndarray:
    """The shingles of a sorted set that come first in the global order, as many as are needed to meet any partner."""
    need = len(s) - _must_share(len(s), c.percent) + 1
    if not len(frequent):
        return s[:need]
    late = frequent[np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)] == s
    rare = s[~late]
    return rare[:need] if len(rare) >= need else np.concatenate([rare, s[late][: need - len(rare)]])


def _frequent(batches: Iterator[pa.RecordBatch], c: JoinConfig) -> Iterator[pa.RecordBatch]:
    """Counts of the shingles that several documents of a split have among their first, in pieces of bounded size."""
    held, size, none = [], 0, np.zeros(0, dtype=U)

    def flush():
        h, k = np.unique(np.concatenate(held), return_counts=True)
        often = k >= c.frequent_in_split
        return pa.RecordBatch.from_arrays([signed(h[often]), pa.array(k[often], pa.int64())], names=["h", "n"])

    for b in batches:
        for s in shingle_sets(b.column("text").to_pylist(), c.n):
            held.append(_first(s, c, none))
            size += len(held[-1])
        if size > 8_000_000:
            yield flush()
            held, size = [], 0
    if held:
        yield flush()


def _buckets(batches: Iterator[pa.RecordBatch], c: JoinConfig, frequent: np.ndarray) -> Iterator[pa.RecordBatch]:
    seen: set[int] = set()
    for b in batches:
        hs, ks, ns = [], [], []
        for s in shingle_sets(b.column("text").to_pylist(), c.n):
            k = int(mix(s, 1).sum(dtype=U))
            if len(s) and k not in seen:
                if len(seen) < 1_000_000:
                    seen.add(k)
                hs.append(_first(s, c, frequent))
                ks.append(np.full(len(hs[-1]), k, dtype=U))
                ns.append(np.full(len(hs[-1]), len(s), dtype=np.int32))
        if hs:
            h, k, n = np.concatenate(hs), np.concatenate(ks), np.concatenate(ns)
            for i in range(0, len(h), 100_000):
                yield pa.RecordBatch.from_arrays([signed(h[i : i + 100_000]), signed(k[i : i + 100_000]), pa.array(n[i : i + 100_000])], names=["h", "k1", "n"])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of seats sorted by bucket and class, those in buckets of several classes, once, with the bucket's first class."""
    held = last = first = None

    def pick(m: np.ndarray, after: int | None) -> pa.RecordBatch:
        nonlocal first, last
        prev = np.concatenate([m[:, :1] if last is None else last[:, None], m[:, :-1]], axis=1)
        new = m[0] != prev[0]
        if last is None:
            new[0] = True
        at = np.maximum.accumulate(np.where(new, np.arange(m.shape[1]), -1))
        head = m[:, np.maximum(at, 0)]
        if first is not None:
            head[:, at < 0] = first[:, None]
        again = (m[1] == prev[1]) & ~new
        fore = np.append(m[0, 1:] == m[0, :-1], after is not None and m[0, -1] == after)
        # A bucket's first class goes along if a row of the same bucket follows; alone, it adds nothing later.
        use = ~again & ((m[1] != head[1]) | fore)
        first, last = head[:, -1].copy(), m[:, -1].copy()
        x, y = m[:, use], head[:, use]
        return pa.RecordBatch.from_arrays([pa.array(x[0]), pa.array(x[1]), pa.array(x[2].astype(np.int32)), pa.array(y[1]), pa.array(y[2].astype(np.int32))], names=["h", "k1", "n", "hub", "hub_n"])

    for b in batches:
        if not b.num_rows:
            continue
        m = np.stack([b.column(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in ("h", "k1", "n")])
        if held is not None:
            yield pick(held, int(m[0, 0]))
        held = m
    if held is not None:
        yield pick(held, None)


def _asked(a: str, b: str, percent: int):
    """Buckets that two classes of these sizes share at least if they link.

    Common shingles up to the earlier of the two last ones are in both selections; after it, the document that ends
    there has ``ceil(t * size) - 1`` left.
    """
    both = F.ceil((F.col(a) + F.col(b)) * percent / (100 + percent) - 1e-9)
    return F.greatest(both - F.ceil(F.greatest(F.col(a), F.col(b)) * percent / 100 - 1e-9) + 1, F.lit(1))


def _alike(a: str, b: str, percent: int):
    return 100 * F.least(F.col(a), F.col(b)) >= percent * F.greatest(F.col(a), F.col(b))


def _most_frequent(counts: DataFrame, most: int) -> np.ndarray:
    """The shingles of ``counts`` (``h, n``) seen most often, sorted: all down to the least count that ``most`` admits."""
    least, held = None, 0
    for n, size in sorted(((r["n"], r["size"]) for r in counts.groupBy("n").agg(F.count(F.lit(1)).alias("size")).collect()), reverse=True):
        held += size
        if held > most:
            break
        least = n
    if least is None:
        return np.zeros(0, dtype=U)
    return np.sort(counts.where(F.col("n") >= least).select("h").toArrow().column("h").to_numpy().view(U))


def across_pairs(own: DataFrame, c: JoinConfig, tmp: Scratch, join: bool = True) -> DataFrame:
    """``u, v`` of classes (or blocks) whose blocks must be joined, of seats ``h, k1, n`` with their block ``g``.

    The blocks that meet in a bucket whose pairs are too many to be counted are joined as well; without ``join`` they are
    not, and the seats ``h, k1`` of these buckets are left in the table ``crowded`` for the caller to compare.
    """
    sizes = own.groupBy("h", "g").agg(F.count(F.lit(1)).alias("k"))
    met = sizes.groupBy("h").agg(F.min("g").alias("lo"), F.max("g").alias("hi"), F.sum("k").alias("m"), F.max(F.struct("k", "g")).alias("top")).where("lo <> hi")
    across = tmp.keep(met.select("h", "lo", "m", F.col("top.g").alias("main"), (F.col("m") * (F.col("m") - F.col("top.k"))).alias("cost")), "across")
    bits = F.ceil(F.log2("cost")).cast("int")
    spread = across.where(F.col("m") > c.pair_bucket).groupBy(bits.alias("bits")).agg(F.sum("cost").alias("cost")).collect()
    left, most = c.pairs_per_seat * own.count() if spread else 0, -1
    for r in sorted(spread):
        left -= r["cost"]
        if left < 0 or 1 << r["bits"] > c.pairs_in_bucket:
            break
        most = r["bits"]
    counted = (F.col("m") <= c.pair_bucket) | (bits <= most)
    crowded = own.join(across.where(~counted).select("h", "lo"), "h")
    if not join:
        tmp.keep(crowded.select("h", "k1"), "crowded")
    mixed = tmp.keep(own.join(across.where(counted).select("h", "main"), "h"), "mixed")
    x = mixed.where("g <> main").select("h", F.col("k1").alias("x"), F.col("n").alias("xn"), F.col("g").alias("xg"))
    y = mixed.select(F.col("h").alias("yh"), F.col("k1").alias("y"), F.col("n").alias("yn"), F.col("g").alias("yg"), (F.col("g") == F.col("main")).alias("in_main"))
    # A pair outside of the main block is met from both sides and counts once.
    pairs = x.join(y, (F.col("h") == F.col("yh")) & (F.col("xg") != F.col("yg")) & (F.col("in_main") | (F.col("x") < F.col("y"))) & _alike("xn", "yn", c.percent))
    first = F.col("x") < F.col("y")
    ends = [F.when(first, F.col(a)).otherwise(F.col(b)).alias(name) for a, b, name in (("x", "y", "u"), ("y", "x", "v"), ("xn", "yn", "un"), ("yn", "xn", "vn"))]
    pairs = pairs.select(*ends).groupBy("u", "v", "un", "vn").agg(F.count(F.lit(1)).alias("k"))
    pairs = pairs.where(F.col("k") >= _asked("un", "vn", c.percent)).select("u", "v")
    return pairs.unionByName(crowded.select(F.col("g").alias("u"), F.col("lo").alias("v")).where("u <> v").distinct()) if join else pairs


def crowded_blocks(crowded: DataFrame, blocks: DataFrame) -> DataFrame:
    """``k1, _g`` of the classes in crowded buckets (seats ``h, k1``) that meet others than their own block's there."""
    seats = crowded.join(blocks, "k1", "left").withColumn("_g", F.coalesce("_g", "k1"))
    open_ = seats.groupBy("h").agg(F.min("_g").alias("lo"), F.max("_g").alias("hi")).where("lo <> hi").select("h")
    return seats.join(open_, "h").select("k1", F.col("h").alias("_g"))


def unit_links(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """For each set the index of the least set it is connected with, by exact overlap counts."""
    m = len(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    label = np.full(m, -1, dtype=np.int64)
    live = np.arange(m)

    def product(rows: np.ndarray):
        """Columns by rarity: each row's columns (rarest first) and each column's rows."""
        flat = np.concatenate([sets[i] for i in rows]) if len(rows) else np.zeros(0, dtype=U)
        _, inv, df = np.unique(flat, return_inverse=True, return_counts=True)
        inv = inv.ravel()
        rank = np.empty(len(df), dtype=np.int64)
        order = np.argsort(df, kind="stable")
        rank[order] = np.arange(len(df))
        col, df = rank[inv], df[order]
        owner = np.repeat(np.arange(len(rows)), sizes[rows])
        by_row = np.lexsort((col, owner))
        col = col[by_row]
        by_col = np.argsort(col, kind="stable")
        return col, np.concatenate([[0], np.cumsum(sizes[rows])]), owner[by_col], np.concatenate([[0], np.cumsum(df)])

    todo: list[int] = []
    place = np.full(m, -1)
    row_cols = row_at = col_rows = col_at = None
    built = 0
    nxt = 0
    free = m
    while free:
        if not todo:
            while label[nxt] >= 0:
                nxt += 1
            label[nxt] = nxt
            free -= 1
            todo = [nxt]
            if not free:
                break
        if row_cols is None or free + 64 < built // 2:  # the product of what is left, and the rows at hand
            live = np.unique(np.concatenate([np.flatnonzero(label < 0), np.array(todo, dtype=np.int64)]))
            place[:] = -1
            place[live] = np.arange(len(live))
            row_cols, row_at, col_rows, col_at = product(live)
            built = free
        p = todo.pop()
        cols = row_cols[row_at[place[p]] : row_at[place[p] + 1]]
        size = len(cols)
        open_ = (label[live] < 0) & (100 * sizes[live] >= percent * size) & (100 * size >= percent * sizes[live])
        if not open_.any():
            continue

        def rows_of(cs: np.ndarray) -> np.ndarray:
            lengths = col_at[cs + 1] - col_at[cs]
            cs, lengths = cs[lengths > 1], lengths[lengths > 1]
            if not len(cs):
                return np.zeros(0, dtype=np.int64)
            start = np.repeat(col_at[cs] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
            return col_rows[start + np.arange(lengths.sum())]

        first = rows_of(cols[: size - _must_share(size, percent) + 1])
        if not open_[first].any():
            continue
        over = np.bincount(rows_of(cols), minlength=len(live))
        hit = live[open_ & (100 * over >= percent * (size + sizes[live] - over))]
        label[hit] = label[p]
        free -= len(hit)
        todo.extend(hit.tolist())
    return label


def _links(batches: Iterator[pa.RecordBatch], c: JoinConfig) -> Iterator[pa.RecordBatch]:
    keys = ["_g", "_i", "_j"]
    for t in grouped(batches, keys):
        at = bounds(t, keys)
        rows, texts = t.column("_row").to_numpy(), t.column("text").to_pylist()
        us, vs = [], []
        for a, b in zip(at[:-1], at[1:], strict=True):
            order = a + np.argsort(rows[a:b], kind="stable")
            order = order[np.concatenate([[True], rows[order][1:] != rows[order][:-1]])]  # a repeated row is one node
            if len(order) < 2:
                continue
            label = unit_links(list(shingle_sets([texts[i] for i in order], c.n)), c.percent)
            hit = np.flatnonzero(label != np.arange(len(order)))
            us.append(rows[order[hit]])
            vs.append(rows[order[label[hit]]])
        if us:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], names=["u", "v"])


def link_documents(docs: DataFrame, config: JoinConfig = JoinConfig()) -> DataFrame:
    """``doc_id, _row, n_shingles, component_id`` of every row; ``_row`` identifies doc_id and text."""
    spark, c = docs.sparkSession, config
    tmp = Scratch(spark)
    texts = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("_row"))
    sets = cut(texts.mapInArrow(lambda it: _sets(it, c.n), "doc_id long, _row long, n_shingles long, k1 long, k2 long"))
    classes = cut(sets.where("n_shingles > 0").groupBy("k1", "k2", "n_shingles").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row")).alias("r")).select("k1", "k2", "n_shingles", "r.doc_id", "r._row"))

    only = docs.select("text")
    often = only.mapInArrow(lambda it: _frequent(it, c), "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    frequent = spark.sparkContext.broadcast(_most_frequent(tmp.keep(often, "often"), c.frequent_list))
    tmp.drop("often")

    seats = only.mapInArrow(lambda it: _buckets(it, c, frequent.value), "h long, k1 long, n int")
    shared = seats.repartition("h").sortWithinPartitions("h", "k1").mapInArrow(_shared, "h long, k1 long, n int, hub long, hub_n int")
    shared = tmp.keep(shared, "shared")
    release(spark)
    to_hub = shared.where((F.col("k1") != F.col("hub")) & _alike("n", "hub_n", c.percent)).groupBy(F.col("k1").alias("u"), F.col("hub").alias("v"), "n", "hub_n").agg(F.count(F.lit(1)).alias("k"))
    near = tmp.keep(to_hub.where(2 * F.col("k") >= _asked("n", "hub_n", c.percent)).select("u", "v"), "near")
    rough = cut(components(near))

    own = shared.select("h", "k1", "n").join(rough.withColumnsRenamed({"node": "k1", "label": "g"}), "k1", "left").withColumn("g", F.coalesce("g", "k1"))
    own = tmp.keep(own, "own")
    tmp.drop("shared")
    edges = tmp.keep(across_pairs(own, c, tmp, join=False).unionByName(rough.select(F.col("node").alias("u"), F.col("label").alias("v"))), "edges")
    tmp.drop("own", "across", "mixed", "near")
    blocks = cut(components(edges).select(F.col("node").alias("k1"), F.col("label").alias("_g")))
    blocks = cut(blocks.unionByName(crowded_blocks(tmp.table("crowded", "h long, k1 long"), blocks)))
    tmp.drop("edges", "crowded")

    members = classes.join(blocks, "k1")
    totals = members.groupBy("_g").agg(F.sum("n_shingles").alias("_all"), F.count(F.lit(1)).alias("_m")).where("_m > 1")
    half = c.unit_shingles // 2
    parts = F.when(F.col("_all") <= c.unit_shingles, 1).otherwise(F.ceil(F.col("_all") / half)).cast("int")
    dealt = members.join(totals, "_g").withColumn("_parts", parts).withColumn("_part", F.pmod(F.xxhash64("_row"), F.col("_parts")).cast("int"))
    mine = F.col("_part")
    units = F.when(F.col("_parts") == 1, F.array(F.struct(F.lit(0).alias("_i"), F.lit(0).alias("_j")))).otherwise(
        F.transform(F.filter(F.sequence(F.lit(0), F.col("_parts") - 1), lambda k: k != mine), lambda k: F.struct(F.least(k, mine).alias("_i"), F.greatest(k, mine).alias("_j")))
    )
    dealt = cut(dealt.select(F.col("_row").alias("_member"), "_g", units.alias("_units")))
    work = texts.join(dealt, F.col("_row") == F.col("_member")).select("_g", F.explode("_units").alias("_u"), "_row", "text").select("_g", "_u._i", "_u._j", "_row", "text")
    work = work.repartition("_g", "_i", "_j").sortWithinPartitions("_g", "_i", "_j")
    links = tmp.keep(work.mapInArrow(lambda it: _links(it, c), "u long, v long"), "links")
    joined = components(links).select(F.col("node").alias("_row"), "label")
    tmp.drop("links")
    named = cut(classes.join(joined, "_row", "left").withColumn("label", F.coalesce("label", "_row")))
    least = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    ids = named.join(least, "label").select("k1", "k2", "n_shingles", "component_id")
    out = sets.join(ids, ["k1", "k2", "n_shingles"], "left")
    return out.select("doc_id", "_row", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, config: JoinConfig = JoinConfig()) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each group the smallest doc_id stays, once."""
    linked = cut(link_documents(docs, config))
    chosen = linked.where("n_shingles > 0").groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row")).alias("r"))
    stay = cut(chosen.select(F.col("r._row").alias("_stay")).unionByName(linked.where("n_shingles = 0").select(F.col("_row").alias("_stay"))).distinct())
    keyed = packed(docs).withColumn("_row", F.xxhash64("__row__.doc_id", "__row__.text")).join(stay, F.col("_row") == F.col("_stay"), "left_semi")
    wordless = F.size(words(F.col("__row__.text"))) == 0
    return unpacked(keyed.where(~wordless).dropDuplicates(["_row"])).unionByName(unpacked(keyed.where(wordless)))
