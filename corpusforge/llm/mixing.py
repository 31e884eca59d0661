"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Each source's documents, in a seeded order, form one stream of words that is cut into blocks of ``block_words``. The
mix has as many block seats as the corpus has blocks; seats go to the sources with the highest quotients
``target / (2k + 1)``, which fixes an integer quota per source and output shard. Seat ``k`` of a source is block
``k mod blocks`` of its stream and lies in the shard whose cumulative quota it falls under; so a source with more seats
than blocks is passed over whole as often as they allow, and the rest of its seats falls on the first blocks of the
seeded order. Exactly the quota is selected, no block table is needed, and of each source at most one document is cut.

Defined cases: a null text has no words and is taken 0 times; a null source is a source of its own, last in code
point order; a null doc_id orders as the empty string; repeated rows stand side by side in the stream and count each;
an empty table, or one without any word, mixes nothing. Input columns other than those named are not read by
``plan_mix`` and are kept by ``mix_documents``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusforge.llm.common import BLANKS, WORD, bucket_digits, cut, packed, small, unpacked, words


@dataclass(frozen=True)
class MixConfig:
    block_words: int = 32
    #: A source's target stops at this many times its size.
    max_repeats: int = 3
    seed: str = "mix-1"
    shards: int = 8


def targets(sizes: DataFrame, config: MixConfig = MixConfig()) -> DataFrame:
    """``source, source_size, target`` from one row per source (``source, source_size``).

    Weights run 1, 2, 3, 1, 2, 3 ... by code point order, null last. In ascending order of size per weight the capped
    sources are a prefix: a source is capped as long as what the prefix leaves over would give it more than its cap.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    ranked = sizes.withColumn("weight", ((F.row_number().over(by_name) - 1) % 3 + 1).cast("long")).withColumn("cap", F.col("source_size") * config.max_repeats)
    by_room = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    ahead = by_room.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    steps = ranked.select(
        "*",
        F.sum("source_size").over(everything).alias("total"),
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(ahead), F.lit(0))).alias("left_over"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(ahead), F.lit(0))).alias("weights"),
        F.row_number().over(by_room).alias("place"),
    ).withColumn("capped", F.col("left_over") * F.col("weight") >= F.col("cap") * F.col("weights"))
    first = F.min(F.when(~F.col("capped"), F.struct("place", "left_over", "weights"))).over(everything)
    share = first["left_over"].cast("double") * F.col("weight") / first["weights"]
    return steps.withColumn("first", first).select(
        "source",
        "source_size",
        F.when(F.col("first").isNull() | (F.col("place") < F.col("first.place")), F.col("cap").cast("double")).otherwise(share).alias("target"),
    )


def quotas(goal: DataFrame, config: MixConfig = MixConfig()) -> DataFrame:
    """Adds ``blocks`` and ``quota``, an array of cumulative seats per output shard, to ``targets``' result.

    A divisor method may be entered at any divisor: rounding ``target / divisor`` to the nearest integer gives each
    source its seats up to a few, and the highest (or lowest) next quotients settle the difference. Since such
    methods never take a seat back as the house grows, the seats of the first ``p`` shards are the result for
    ``p / shards`` of the house.
    """
    b = config.block_words
    every = Window.partitionBy("shard")
    house = goal.withColumn("blocks", F.ceil(F.col("source_size") / b).cast("long")).withColumn("shard", F.explode(F.sequence(F.lit(1), F.lit(config.shards))))
    house = house.withColumn("seats", F.floor(F.floor(F.sum("source_size").over(every) / b + 0.5) * F.col("shard") / config.shards).cast("long"))
    most = F.col("blocks") * config.max_repeats
    start = F.floor(F.col("target") * F.col("seats") / F.sum("target").over(every) + 0.5).cast("long")
    house = house.withColumn("start", F.coalesce(F.least(start, most), F.lit(0))).withColumn("gap", F.col("seats") - F.sum("start").over(every))
    # One candidate seat for each of |gap| steps: quotients of seats to add, or of those to give back.
    step = F.explode(F.sequence(F.lit(0).cast("long"), F.abs("gap")))
    seat = house.withColumn("k", step).withColumn("odd", F.when(F.col("gap") > 0, 2 * (F.col("start") + F.col("k")) + 1).otherwise(2 * (F.col("start") - F.col("k")) - 1))
    usable = (F.col("k") < F.abs("gap")) & (F.col("odd") > 0) & F.when(F.col("gap") > 0, (F.col("start") + F.col("k") < most) & (F.col("target") > 0)).otherwise(True)
    quotient = F.when(usable, F.when(F.col("gap") > 0, -F.col("target")).otherwise(F.col("target")) / F.col("odd"))
    # Equal quotients win in code point order, so the last of them is given back first.
    named = F.row_number().over(Window.partitionBy("shard").orderBy(F.col("source").isNull(), F.col("source"), "k"))
    seat = seat.withColumn("tie", F.when(F.col("gap") > 0, named).otherwise(-named))
    in_order = Window.partitionBy("shard").orderBy(quotient.asc_nulls_last(), "tie")
    chosen = seat.withColumn("usable", usable).withColumn("n", F.row_number().over(in_order))
    moved = F.sum(F.when(F.col("usable") & (F.col("n") <= F.abs("gap")), F.signum("gap")).otherwise(0)).cast("long")
    done = chosen.groupBy("source", "source_size", "target", "blocks", "shard", "start").agg(moved.alias("moved"))
    return done.groupBy("source", "source_size", "target", "blocks").agg(F.transform(F.array_sort(F.collect_list(F.struct("shard", (F.col("start") + F.col("moved")).alias("q")))), lambda x: x["q"]).alias("quota"))


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _order(doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def plan_mix(docs: DataFrame, config: MixConfig = MixConfig(), wide: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(placed, sources)``: each row's place in its source's stream, and each source's target and quota.

    ``placed`` has ``doc_id, source, size, offset`` and, if ``wide``, the other columns of ``docs``. A source may hold
    any share of the rows, so streams are summed within digest buckets of bounded size and the buckets' totals give
    offsets. Equal rows (same doc_id and text) are interchangeable.
    """
    rows = packed(docs)
    row = {c: F.col(f"__row__.{c}") for c in ("doc_id", "source", "text")}
    sized = rows.select(*["__row__"] * wide, row["doc_id"].alias("doc_id"), row["source"].alias("source"), F.size(words(row["text"])).cast("long").alias("_size"), F.xxhash64(row["doc_id"], row["text"]).alias("_key"))
    sized = sized.withColumn("_order", _order(F.col("doc_id"), config.seed))
    narrow = cut(sized.select("source", "_size", "_order") if wide else sized)
    sources = cut(quotas(targets(narrow.groupBy("source").agg(F.sum("_size").alias("source_size")), config), config))
    bucket = F.substring("_order", 1, bucket_digits(narrow.count()))
    before = Window.partitionBy("_s").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sums = narrow.groupBy(F.col("source").alias("_s"), bucket.alias("_b")).agg(F.sum("_size").alias("_sum"))
    starts = cut(sums.select("_s", "_b", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start")))
    placed = (sized if wide else narrow).withColumn("_bucket", bucket)
    inside = Window.partitionBy("source", "_bucket").orderBy("_order", "doc_id", "_size", "_key").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("_in", F.coalesce(F.sum("_size").over(inside), F.lit(0)))
    placed = placed.join(small(starts), F.col("source").eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b")))
    return placed.withColumn("_offset", F.col("_start") + F.col("_in")), sources


def with_sources(placed: DataFrame, sources: DataFrame) -> DataFrame:
    seats = F.element_at("quota", -1)
    passes = F.when(F.col("blocks") > 0, _div(seats, F.col("blocks"))).otherwise(0).cast("long")
    s = sources.select(F.col("source").alias("_of"), F.col("source_size").alias("_source_size"), F.col("target").alias("_target"), F.col("quota").alias("_quota"), passes.alias("_passes"), (seats - passes * F.col("blocks")).alias("_extra"))
    return placed.join(small(s), F.col("source").eqNullSafe(F.col("_of")))


def extra_words(size: Column, offset: Column, extra: Column, block_words: int) -> Column:
    """Words of ``[offset, offset + size)`` that lie in the first ``extra`` blocks, which the partial pass selects."""
    return F.greatest(F.least(size, extra * block_words - offset), F.lit(0)).cast("long")


def leading_words(text: Column, n: Column) -> Column:
    """``text`` up to the end of its ``n``-th word, its white space kept; ``n`` is 1 at least and it has so many."""
    runs = F.regexp_extract_all(text, F.lit(f"{WORD}[\\x20\\x09-\\x0D]*"), F.lit(0))
    lead = F.regexp_extract(text, "^[\\x20\\x09-\\x0D]*", 0)
    return F.concat(lead, F.rtrim(F.array_join(F.slice(runs, F.lit(1), n.cast("int")), ""), F.lit(BLANKS)))


def mix_report(docs: DataFrame, config: MixConfig = MixConfig()) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` of every row, how often its source is passed over whole, and the
    output shard (from 1) of the first word taken from it, null if none is."""
    x = with_sources(*plan_mix(docs, config))
    taken = F.col("_passes") * F.col("_size") + extra_words(F.col("_size"), F.col("_offset"), F.col("_extra"), config.block_words)
    seat = _div(F.col("_offset"), F.lit(config.block_words))
    shard = F.size(F.filter("_quota", lambda q: q <= seat)).cast("long") + 1
    return x.select("doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), taken.cast("long").alias("taken"), F.col("_passes").alias("whole_passes"), F.when(taken > 0, shard).alias("first_shard"))


def mix_documents(docs: DataFrame, config: MixConfig = MixConfig()) -> DataFrame:
    """The mix as rows of ``docs``: one row per whole pass over the source, and one for the last, partial pass, whose
    text is the document's or, of one document per source, its beginning (``n_chars``, if present, is its length)."""
    x = with_sources(*plan_mix(docs, config, wide=True))
    text = F.col("__row__.text")
    n_extra = extra_words(F.col("_size"), F.col("_offset"), F.col("_extra"), config.block_words)
    whole = F.when(F.col("_size") > 0, F.array_repeat(text, F.col("_passes").cast("int"))).otherwise(F.array())
    part = F.when(n_extra == F.col("_size"), text).otherwise(leading_words(text, n_extra))
    texts = F.concat(whole, F.when(n_extra > 0, F.array(part)).otherwise(F.array()))
    return unpacked(x.withColumn("_text", F.explode(texts)), text=F.col("_text"), n_chars=F.length("_text").cast("long"))
