"""Corpus recipes of model families as data, and the plan that runs one of them.

``python -m corpusforge.plans.recipes --recipe mistral --input '/crawl/*.jsonl' --output /blocks --tokenizer file.json``
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.functions import text as T
from corpusforge.operators import near_dup, tokenizers
from corpusforge.operators.ordering import spread, with_index
from corpusforge.operators.packing import checked_cast, pack
from corpusforge.sources import io


@dataclass(frozen=True)
class Recipe:
    bos: str
    eos: str
    chunk_words: int
    block: int
    id_bits: int = 32


# Sentinels, words a chunk, tokens a block and bits an id of each family.
RECIPES = {
    "llama-v1": Recipe("", "</s>", 2500, 1024),
    "llama-v2": Recipe("<s>", "</s>", 500, 32768),
    "mistral": Recipe("<s>", "</s>", 500, 4096, 16),
    "yi": Recipe("<|startoftext|>", "<|endoftext|>", 500, 4096, 16),
    "tinyllama": Recipe("<s>", "</s>", 500, 4096, 16),
    "solar": Recipe("<s>", "</s>", 500, 4096, 16),
    "litellama": Recipe("<s>", "</s>", 500, 4096),
    "gemma": Recipe("<bos>", "<eos>", 500, 8192),
    "llama-3": Recipe("<|begin_of_text|>", "<|end_of_text|>", 500, 8192),
    "qwen2": Recipe("<|endoftext|>", "<|endoftext|>", 500, 16384),
    "smollm": Recipe("<|endoftext|>", "<|endoftext|>", 500, 4096),
    "clm": Recipe("<s>", "</s>", 500, 4096),
    "llm-mix": Recipe("<s>", "</s>", 500, 4096, 16),
}
# End of fixed values.


def combine(docs: DataFrame, recipe: Recipe) -> DataFrame:
    """``doc_id, source, pos, text``: cleaned documents between sentinels, without exam papers, in chunks."""
    # One array element each: a filter on the text, or one that Spark infers from an inner explode, would clean it again.
    wrapped = F.array(F.concat(F.lit(recipe.bos), T.clean(F.col("text")), F.lit(recipe.eos)))
    kept = F.filter(wrapped, lambda t: T.let(F.lower(t), lambda low: ~T.contains_any(low, T.EXAM_PHRASES)))
    texts = docs.select("doc_id", "source", F.explode_outer(kept).alias("text")).where("text IS NOT NULL")
    return texts.select("doc_id", "source", F.posexplode_outer(T.chunks(F.col("text"), recipe.chunk_words)).alias("pos", "text")).where("pos IS NOT NULL")


def blocks(chunks: DataFrame, recipe: Recipe, tokenizer: str | None = None, is_arranged: bool = False) -> DataFrame:
    """``source, block, tokens``: ids of a tokenizer file, or words where none is given, in full blocks per source."""
    if tokenizer is None:
        return pack(chunks, T.tokens(F.col("text")), recipe.block, ["source"], ["doc_id", "pos"], is_arranged, words=True)
    special = tuple(dict.fromkeys(s for s in (recipe.bos, recipe.eos) if s)) if tokenizer.endswith(".json") else ()
    packed = pack(chunks, tokenizers.encode(F.col("text"), tokenizer, special), recipe.block, ["source"], ["doc_id", "pos"], is_arranged)
    return packed.withColumn("tokens", F.transform("tokens", lambda i: checked_cast(i, recipe.id_bits).cast("int")))


def run(spark: SparkSession, name: str, docs: DataFrame, out: str, tokenizer: str | None = None, threshold: float | None = 0.95, rows: int = 30_000) -> DataFrame:
    """Deduplicates (unless ``threshold`` is None), combines, packs and writes; returns rows and bytes by stage."""
    recipe = RECIPES[name]
    docs = spread(docs)
    unique = docs
    if threshold is not None:
        unique = docs.join(near_dup.representatives(near_dup.cluster(docs, threshold, min_length=1)), "doc_id", "left_semi")
    io.write_table(unique, f"{out}/deduplicated")
    unique = spark.read.parquet(f"{out}/deduplicated")
    io.write_table(combine(unique, recipe), f"{out}/chunks")
    chunks = spark.read.parquet(f"{out}/chunks")
    io.write_blocks(blocks(chunks, recipe, tokenizer), f"{out}/blocks", rows)
    sizes = [d.agg(F.lit(s).alias("stage"), F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes")) for s, d in (("raw", docs), ("deduplicated", unique), ("chunks", chunks))]
    return sizes[0].unionByName(sizes[1]).unionByName(sizes[2])


def main() -> None:
    from corpusforge.session import build

    p = argparse.ArgumentParser(description="Run a corpus recipe over JSON lines of objects with a text field.")
    p.add_argument("--recipe", choices=sorted(RECIPES), required=True)
    p.add_argument("--input", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--tokenizer")
    p.add_argument("--text-key", default="text")
    p.add_argument("--threshold", type=float, default=0.95)
    p.add_argument("--keep-duplicates", action="store_true")
    a = p.parse_args()
    spark = build()
    read = io.jsonl_objects(spark, a.input).select(F.get_json_object("value", f"$.{a.text_key}").alias("text"), "source")
    docs = with_index(read.where("text IS NOT NULL"), ["source", "text"], "doc_id")
    run(spark, a.recipe, docs, a.output, a.tokenizer, None if a.keep_duplicates else a.threshold).show(truncate=False)


if __name__ == "__main__":
    main()
