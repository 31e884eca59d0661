"""The queries of this subpackage, each over its whole table with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusforge.llm import chat, compact_windows, decontaminate, jump, langid, mixing, ngram_join, oracles, quality, style_tree, substring_exact
from corpusforge.llm.common import table


def op1_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = chat.rotate(table(spark, sf_dir, "conversations"))
    spans = F.array_join(F.transform("masks", lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return out.select("conv_id", "speaker", "part", "first_turn", "n_turns", "text", spans.alias("mask_spans"), "n_target_chars")


def op2_sainte_lague_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op3_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jump.shard_documents(table(spark, sf_dir, "documents"))


def op4_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compact_windows.find_passages(table(spark, sf_dir, "documents"))


def op5_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"))


def op6_site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return style_tree.extract_pages(table(spark, sf_dir, "pages"))


def op7_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_exact.remove_repeats(table(spark, sf_dir, "documents"))


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_documents(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op9_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_documents(table(spark, sf_dir, "documents")).withColumn("lang_set", F.array_join("lang_set", ","))


def op10_containment_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("_doc")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_perspective_rotation,
        op2_sainte_lague_mix,
        op3_jump_shards,
        op4_compact_windows,
        op5_host_rules,
        op6_site_style_tree,
        op7_repeated_strings,
        op8_ngram_join,
        op9_language_mixture,
        op10_containment_search,
        pipeline,
    )
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    """What SQL can express; the others are held against brute force, round trips or held-out labels in the tests."""
    import corpus_pipeline

    return {
        "op1_perspective_rotation": oracles.chat(),
        "op2_sainte_lague_mix": f"WITH {oracles.mixing('documents')}\nSELECT * FROM m_out",
        "op3_jump_shards": f"WITH RECURSIVE {oracles.sharding('documents')}\nSELECT * FROM s_out",
        "op5_host_rules": f"WITH {oracles.quality('documents')}\nSELECT * FROM q_out",
        "op8_ngram_join": f"WITH RECURSIVE {oracles.ngram_join('documents')}\nSELECT * FROM j_out",
        "op10_containment_search": f"WITH {oracles.contamination('documents')}\nSELECT * FROM c_out",
        "pipeline": corpus_pipeline.ORACLE_SQL,
    }
