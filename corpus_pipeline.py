"""From raw documents to training shards: quality rules, near-duplicate removal, decontamination, mixing, sharding.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept; all but the last return the
columns of ``documents``. The mix repeats rows and may return part of a document, so a doc_id can occur more than
once from there on. Nulls, empty tables and other columns are treated as the operators' modules state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusforge.llm import decontaminate, jump, mixing, ngram_join, oracles, quality
from corpusforge.llm.common import Scratch, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jump.shard_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("source_mixing", mix_sources),
    ("sharding", shards),
]

ORACLE_SQL = oracles.pipeline()


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    tmp = Scratch(spark)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = tmp.keep(docs, name)
            if k:
                tmp.drop(STAGES[k - 1][0])
    return docs
