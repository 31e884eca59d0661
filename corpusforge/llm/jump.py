"""Sharding by jump consistent hashing (Lamping and Veach, 2014), in DataFrame functions only.

A row's shard depends on its key and the number of shards alone; with one more shard, about ``1/(n+1)`` of the
rows move, all of them into the new shard.

An integer key is hashed as it is; a key of another type, such as a string, by its 64-bit xxHash.

Defined cases: a null key hashes as 0; a null text counts no bytes and has a null checksum; repeated rows share a
shard and get a slot each; an empty table gives no rows. Input columns other than the three named are not read, so
names that clash with result columns do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from corpusforge.llm.common import bucket_digits, cut, small

#: Multiplier of the generator that the published algorithm fixes.
MULTIPLIER = 2862933555777941757
SHARDS = 40
OVERHEAD = 16

_LOW = 0xFFFFFFFF


def _times_plus_one(key: Column) -> Column:
    """``key * MULTIPLIER + 1`` modulo 2**64, without an overflow in any single step.

    The key splits into 32-bit halves and the multiplier into 22-bit limbs, so that each product fits a long;
    shifts wrap, and the sum is carried out on 32-bit halves.
    """
    c0, c1, c2 = MULTIPLIER & 0x3FFFFF, (MULTIPLIER >> 22) & 0x3FFFFF, MULTIPLIER >> 44
    low, high = key.bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(key, 32)
    parts = [
        low * F.lit(c0),
        F.shiftleft(low * F.lit(c1), 22),
        F.shiftleft(low * F.lit(c2), 44),
        F.shiftleft(high * F.lit(c0), 32),
        F.shiftleft(high * F.lit(c1), 54),
    ]
    lows = F.lit(1).cast("long")
    highs = F.lit(0).cast("long")
    for p in parts:
        lows = lows + p.bitwiseAND(F.lit(_LOW))
        highs = highs + F.shiftrightunsigned(p, 32)
    highs = highs + F.shiftrightunsigned(lows, 32)
    return F.shiftleft(highs, 32).bitwiseOR(lows.bitwiseAND(F.lit(_LOW)))


def jump_hash(key: Column, shards: int) -> Column:
    """``struct(shard, grown_shard)``: the bucket of a long key among ``shards`` and among ``shards + 1``.

    Both follow one sequence of jumps: the last landing place below the number of shards.
    """
    start = F.struct(
        F.coalesce(key.cast("long"), F.lit(0).cast("long")).alias("key"),
        F.lit(0).cast("long").alias("at"),
        F.lit(0).cast("long").alias("shard"),
        F.lit(0).cast("long").alias("grown"),
    )

    def step(s: Column, _: Column) -> Column:
        key = _times_plus_one(s["key"])
        return F.when(s["at"] > shards, s).otherwise(
            F.element_at(
                F.transform(
                    F.array(key),
                    lambda k: F.element_at(
                        F.transform(
                            F.array(F.floor((s["at"] + 1) * (F.lit(2147483648.0) / (F.shiftrightunsigned(k, 33) + 1)))),
                            lambda j: F.struct(
                                k.alias("key"),
                                j.alias("at"),
                                F.when(j < shards, j).otherwise(s["shard"]).alias("shard"),
                                F.when(j < shards + 1, j).otherwise(s["grown"]).alias("grown"),
                            ),
                        ),
                        1,
                    ),
                ),
                1,
            )
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(shards + 1)), start, step, lambda s: F.struct(s["shard"].cast("int").alias("shard"), s["grown"].cast("int").alias("grown")))


def shard_documents(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, size, text_crc32, law, shard, slot, grown_shard`` of every row.

    Slots number a shard's rows from 0 in the order of the MD5 of key and checksum. A shard grows with the table, so
    rows are numbered within digest buckets of bounded size, whose offsets come from their counts.
    """
    rows = docs.select(
        F.col(key).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.crc32(F.encode(F.col(text), "UTF-8")).alias("text_crc32"),
    )
    whole = isinstance(rows.schema["doc_id"].dataType, IntegralType)
    hashed = F.col("doc_id") if whole else F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id"))
    placed = rows.withColumn("_jump", jump_hash(hashed, shards)).withColumn("_order", F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce(F.col("text_crc32").cast("string"), F.lit("")))))
    placed = cut(placed.select("doc_id", "size", "text_crc32", F.col("_jump.shard").alias("shard"), F.col("_jump.grown").alias("grown_shard"), "_order"))
    digits = bucket_digits(placed.count() // shards)
    placed = placed.withColumn("_bucket", F.substring("_order", 1, digits))
    counts = placed.groupBy("shard", "_bucket").count()
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut(counts.select("shard", "_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset")))
    within = Window.partitionBy("shard", "_bucket").orderBy("_order", "doc_id", "size")
    numbered = placed.withColumn("_n", F.row_number().over(within)).join(small(offsets), ["shard", "_bucket"])
    return numbered.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("_offset") + F.col("_n") - 1).cast("long").alias("slot"),
        "grown_shard",
    )
