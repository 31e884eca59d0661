"""Benchmark decontamination by size-partitioned MinHash containment search, in DataFrame functions only.

Test items are small sets of five-word shingles, documents large ones, so Jaccard similarity says nothing and the
search is by containment. Items are partitioned by size. An item's signature is its smallest shingle hashes, as many
as its partition needs: at a containment of ``t``, at most ``(1 - t) * size`` shingles are missing from the document,
so one more than that many signature hashes cannot all miss, and no pair at the threshold is lost. A document that
has a hash of an item's signature is a candidate; candidates are verified by counting exact shingles.

Defined cases: shingles are taken from words after lower-casing A-Z. An item or document with fewer than five words
has its whole sequence as one shingle, so such an item is found only in a document that consists of it; without
words, there are none and nothing matches. A null doc_id or item_id is carried along. Repeated rows (same doc_id and
text) give one row per item, as do repeated items (same item_id and text). Empty tables give no rows. No columns but
``doc_id``, ``text`` and ``item_id`` are read, and ``drop_contaminated`` keeps all of the documents'.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusforge.llm.common import ascii_lower, cut, let, packed, small, unpacked, words

SHINGLE = 5
THRESHOLD = 0.75


def shingle_hashes(text: Column, n: int = SHINGLE) -> Column:
    """Hashes of a text's shingles in order, repeats included."""
    return let(
        words(ascii_lower(text)),
        lambda w: F.when(F.size(w) == 0, F.array().cast("array<bigint>"))
        .when(F.size(w) < n, F.array(F.xxhash64(w)))
        .otherwise(F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.xxhash64(F.slice(w, i, n)))),
    )


def shingle_strings(text: Column, n: int = SHINGLE) -> Column:
    """The distinct shingles of a text as strings."""
    return let(
        words(ascii_lower(text)),
        lambda w: F.when(F.size(w) == 0, F.array().cast("array<string>"))
        .when(F.size(w) < n, F.array(F.array_join(w, " ")))
        .otherwise(F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.array_join(F.slice(w, i, n), " ")))),
    )


def signatures(items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``_item, _hash``: each item's smallest hashes, as many as the largest size of its partition asks for.

    Partition ``p`` holds items of ``2**p`` to ``2**(p+1) - 1`` shingles.
    """
    h = items.select("_item", F.sort_array(F.array_distinct(shingle_hashes(F.col("text")))).alias("h")).where(F.size("h") > 0)
    largest = F.pow(F.lit(2.0), F.floor(F.log2(F.size("h"))) + 1) - 1
    need = F.floor(largest * (1 - threshold) + 1e-9) + 1
    return h.select("_item", F.explode(F.slice("h", F.lit(1), need.cast("int"))).alias("_hash"))


def find_contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``_doc, doc_id, item_id, item_shingles, shared_shingles, containment`` of each pair at the threshold.

    ``_doc`` identifies documents with the same doc_id and text.
    """
    items = cut(items.select("item_id", "text", F.xxhash64("item_id", "text").alias("_item")).dropDuplicates(["_item"]))
    keyed = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("_doc"))
    found = keyed.select("_doc", F.explode(shingle_hashes(F.col("text"))).alias("_hash"))
    pairs = cut(found.join(small(cut(signatures(items, threshold))), "_hash").select("_doc", "_item").distinct())

    # Verification reads only the candidates' texts again; of these, only shingles of items go on.
    suspects = small(cut(pairs.select("_doc").distinct()))
    held = keyed.join(suspects, "_doc", "left_semi").select("_doc", "doc_id", F.explode(shingle_strings(F.col("text"))).alias("_shingle")).withColumn("_hash", F.xxhash64("_shingle"))
    wanted = cut(items.select("_item", "item_id", F.explode(shingle_strings(F.col("text"))).alias("_shingle")).withColumn("_hash", F.xxhash64("_shingle")))
    sizes = wanted.groupBy("_item").agg(F.count(F.lit(1)).alias("item_shingles"))
    hits = held.join(small(wanted), ["_hash", "_shingle"]).join(small(pairs), ["_doc", "_item"], "left_semi")
    # Equal rows repeat their hits; distinct shingles count once.
    counts = hits.groupBy("_doc", "_item", "doc_id", "item_id").agg(F.countDistinct("_hash").alias("shared_shingles"))
    out = counts.join(small(cut(sizes)), "_item").where(F.col("shared_shingles") >= threshold * F.col("item_shingles"))
    return out.select("_doc", "doc_id", "item_id", "item_shingles", "shared_shingles", (F.col("shared_shingles") / F.col("item_shingles")).alias("containment"))


def drop_contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns."""
    bad = small(cut(find_contaminated(docs, items, threshold).select("_doc").distinct()))
    keyed = packed(docs).withColumn("_key", F.xxhash64("__row__.doc_id", "__row__.text"))
    return unpacked(keyed.join(bad, F.col("_key") == F.col("_doc"), "left_anti"))
