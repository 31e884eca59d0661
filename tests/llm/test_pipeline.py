"""All five stages over odd rows: nulls, repeated rows, very long words, empty tables, clashing columns."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(k):
    return " ".join(f"w{(k * 7 + j * j) % 997}a{j}" for j in range(60))


ODD = [
    (1, prose(1), "en", "a", 9), (1, prose(1), "en", "a", 9), (2, prose(1), None, None, None), (3, prose(3), "en", "a", 1), (4, None, "en", "a", 0), (5, "", "en", "a", 0),
    (6, prose(6) + " " + "x" * 200_000, None, "b", 5), (7, prose(7), "en", None, 3), (8, "a\n" * 40, "en", "b", 80), (9, prose(9) + "\t" + prose(10), "en", "c", 9),
]


@pytest.mark.parametrize(
    ("docs", "items", "kept"),
    [(ODD, [(1, None), (2, ""), (3, "a b"), (4, prose(7)), (4, prose(7))], {1, 3, 6, 9}), (ODD, [], {1, 3, 6, 7, 9}), ([], [(1, prose(7))], set()), ([], [], set())],
)
def test_odd_rows_through_all_stages(spark, tmp_path, docs, items, kept):
    extra = spark.createDataFrame(docs, DOCS).withColumn("size", F.lit(1)).withColumn("shard", F.lit("x")).withColumn("_row", F.lit(2))
    extra.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in got} == kept
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
