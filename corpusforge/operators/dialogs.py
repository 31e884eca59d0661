"""Conversations: ordered turns, markup, filters and templates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.functions.text import prefix_key, strip


def gather(turns: DataFrame) -> DataFrame:
    """``conv_id, chat``: a conversation's turns in order."""
    return turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("chat"))


def echoes(chat: Column) -> Column:
    """True if a turn begins like the one before it; the first is compared with the last."""
    keys = F.transform(chat, lambda t: prefix_key(t["text"]))
    return F.exists(F.sequence(F.lit(1), F.size(chat)), lambda i: F.element_at(keys, i) == F.when(i == 1, F.element_at(keys, -1)).otherwise(F.get(keys, i - 2)))


def markup(chat: Column) -> Column:
    """Turns as ``<manusia>:`` and ``<bot>:`` lines."""
    return F.array_join(F.transform(chat, lambda t: F.concat(F.when(t["role"] == "assistant", F.lit("<bot>: ")).otherwise(F.lit("<manusia>: ")), t["text"])), "\n")


def parse_markup(text: Column) -> Column:
    """``array<struct<role, content>>`` of a marked-up dialogue; a person's part without an answer is skipped."""
    parts = F.filter(F.split(text, "<manusia>:"), lambda p: F.size(F.split(p, "<bot>:")) == 2)
    pair = F.transform(parts, lambda p: F.array(F.struct(F.lit("user").alias("role"), strip(F.element_at(F.split(p, "<bot>:"), 1)).alias("content")), F.struct(F.lit("assistant").alias("role"), strip(F.element_at(F.split(p, "<bot>:"), 2)).alias("content"))))
    return F.when(text.contains("<bot>:"), F.flatten(pair))


def until_null(chat: Column) -> Column:
    """The turns before the first one without text."""
    at = F.array_position(F.transform(chat, lambda t: t["text"].isNull()), True)
    return F.when(at > 0, F.slice(chat, F.lit(1), F.greatest(at - 1, F.lit(0)).cast("int"))).otherwise(chat)


def even(chat: Column) -> Column:
    return F.slice(chat, F.lit(1), F.size(chat) - F.size(chat) % 2)


def turn_pairs(chat: Column) -> Column:
    """Each two turns as ``struct<k, q, a>``; an odd last turn is dropped."""
    n = F.floor(F.size(chat) / 2).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.struct(k.alias("k"), F.get(chat, 2 * k)["text"].alias("q"), F.get(chat, 2 * k + 1)["text"].alias("a")))).otherwise(F.array().cast("array<struct<k:int,q:string,a:string>>"))
