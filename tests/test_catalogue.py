import pytest
from conftest import SMALL, oracle_rows, rows

from corpusforge.plans import catalogue


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_same_rows_as_sql(spark, duck, name):
    assert rows(catalogue.QUERIES[name](spark, SMALL)) == oracle_rows(duck, catalogue.ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_runs(spark, name):
    assert catalogue.QUERIES[name](spark, SMALL).count() >= 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_pipeline_keeps_texts_whatever_their_id(spark, tmp_path):
    docs = [(i, "s", "en", " ".join(f"d{i}w{j}" for j in range(128))) for i in range(14)]
    spark.createDataFrame(docs, "doc_id long, source string, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    text = " ".join(r["text"] for r in catalogue.QUERIES["e1_pipeline"](spark, str(tmp_path)).collect())
    assert all(f"d{i}w5 " in text for i in range(14))


def test_jaccard_of_whole_texts(spark, tmp_path):
    texts = ["same " * 80 + end for end in ("one ending of a text", "quite another close", "one ending of a book")]
    spark.createDataFrame([(i, "s", t) for i, t in enumerate(texts)], "doc_id long, source string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    sets = [{t[i : i + 8] for i in range(len(t) - 7)} for t in texts]
    got = {r["doc_id"]: r["jaccard"] for r in catalogue.QUERIES["h7_jaccard_pairs"](spark, str(tmp_path)).collect()}
    assert got == pytest.approx({i: len(sets[i] & sets[i + 1]) / len(sets[i] | sets[i + 1]) for i in range(2)})


@pytest.mark.parametrize(("threshold", "kept"), [("095", 926), ("070", 894)])
def test_minhash_clusters_keep_the_known_number(spark, threshold, kept):
    docs = "/root/testdata/sf0.01"
    ids = [r["doc_id"] for r in catalogue.QUERIES[f"d6_minhash_dedup_{threshold}"](spark, docs).select("doc_id").collect()]
    assert len(ids) == len(set(ids)) == kept
