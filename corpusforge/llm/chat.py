"""Chat formatting by perspective rotation.

For every participant of a conversation, the dialogue is rendered with that participant as the assistant and all
others as named users; the mask marks what the assistant says. System turns belong to nobody and stay system turns.
A conversation of any length is rendered in parts of ``part_turns`` turns, each a row whose text continues the last,
so that no task ever holds a whole conversation.

Defined cases: turns are ordered by turn number (null first), role and text; a null text is empty; a null or empty
role is a participant named ``unknown``; repeated rows are turns of their own; a conversation without participants
(system turns only) has no perspective and no rows; an empty table gives no rows. A null conv_id is a conversation.
Control tags inside texts are left as they are; the mask is by position, so they cannot shift it. Columns other than
the four named are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusforge.llm.common import cut, small


@dataclass(frozen=True)
class ChatConfig:
    part_turns: int = 64
    #: Turn numbers per numbering bucket.
    bucket_turns: int = 4096
    system: str = "system"
    open: str = "<|im_start|>"
    close: str = "<|im_end|>\n"


def numbered(turns: DataFrame, config: ChatConfig = ChatConfig()) -> DataFrame:
    """Adds ``_n``, each turn's place in its conversation from 0.

    Places are counted within buckets of turn numbers and shifted by the counts of earlier buckets, as one
    conversation may hold any share of the rows.
    """
    bucketed = turns.withColumn("_bucket", F.coalesce(F.floor(F.col("turn") / config.bucket_turns), F.lit(-(1 << 60))))
    counts = bucketed.groupBy(F.col("conv_id").alias("_c"), F.col("_bucket").alias("_b")).agg(F.count(F.lit(1)).alias("_k"))
    before = Window.partitionBy("_c").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    # Only conversations of more than one bucket need a shift.
    shift = counts.withColumn("_shift", F.sum("_k").over(before)).where("_shift IS NOT NULL").drop("_k")
    inside = Window.partitionBy("conv_id", "_bucket").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    placed = bucketed.withColumn("_i", F.row_number().over(inside))
    joined = placed.join(small(cut(shift)), F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("_bucket") == F.col("_b")), "left")
    return joined.select("conv_id", "turn", "role", "text", (F.col("_i") - 1 + F.coalesce("_shift", F.lit(0))).alias("_n"))


def rotate(turns: DataFrame, config: ChatConfig = ChatConfig()) -> DataFrame:
    """``conv_id, speaker, part, first_turn, n_turns, text, masks, n_target_chars`` for every participant and part.

    ``masks`` lists the spans ``start, end`` (code points of ``text``) that the assistant is to produce: its words and
    the closing tag.
    """
    name = F.when(F.coalesce("role", F.lit("")) == "", "unknown").otherwise(F.col("role"))
    clean = turns.select("conv_id", "turn", name.alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    placed = numbered(clean, config).withColumn("part", F.floor(F.col("_n") / config.part_turns))
    speakers = clean.where(F.col("role") != config.system).select(F.col("conv_id").alias("_c"), F.col("role").alias("speaker")).distinct()
    # A part is a bounded group; it is gathered once and then rendered for each speaker.
    parts = placed.groupBy("conv_id", "part").agg(F.array_sort(F.collect_list(F.struct("_n", "role", "text"))).alias("_turns"))
    seen = parts.join(speakers.groupBy("_c").agg(F.array_sort(F.collect_set("speaker")).alias("_speakers")), F.col("conv_id").eqNullSafe(F.col("_c")))
    view = seen.withColumn("speaker", F.explode("_speakers"))

    def head(t: Column) -> Column:
        mine = F.when(t["role"] == F.col("speaker"), F.lit("assistant")).when(t["role"] == config.system, F.lit(config.system)).otherwise(F.concat(F.lit("user name="), t["role"]))
        return F.concat(F.lit(config.open), mine, F.lit("\n"))

    pieces = F.transform("_turns", lambda t: F.struct(head(t).alias("head"), F.concat(t["text"], F.lit(config.close)).alias("body"), (t["role"] == F.col("speaker")).alias("mine")))
    view = view.select("conv_id", "speaker", "part", F.element_at("_turns", 1)["_n"].alias("first_turn"), F.size("_turns").alias("n_turns"), pieces.alias("_p"))
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")
    spans = F.aggregate(
        "_p",
        F.struct(F.lit(0).cast("long").alias("at"), empty.alias("spans")),
        lambda a, p: F.struct(
            (a["at"] + F.length(p["head"]) + F.length(p["body"])).cast("long").alias("at"),
            F.when(p["mine"], F.concat(a["spans"], F.array(F.struct((a["at"] + F.length(p["head"])).cast("long").alias("start"), (a["at"] + F.length(p["head"]) + F.length(p["body"])).cast("long").alias("end"))))).otherwise(a["spans"]).alias("spans"),
        ),
        lambda a: a["spans"],
    )
    out = view.withColumn("text", F.array_join(F.transform("_p", lambda p: F.concat(p["head"], p["body"])), "")).withColumn("masks", spans)
    total = F.aggregate("masks", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return out.select("conv_id", "speaker", F.col("part").cast("long"), F.col("first_turn").cast("long"), F.col("n_turns").cast("long"), "text", "masks", total.alias("n_target_chars"))
