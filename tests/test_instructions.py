import json

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusforge.functions import text as T
from corpusforge.operators import html, near_dup, records, templates, tokenizers, vectors
from corpusforge.plans import recipes
from corpusforge.sources import io

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def test_xxh3_golden(spark):
    t = F.lit("hello world")
    assert [int(value(spark, T.xxh3(t, 16, s))) for s in (0, 42, -42)] == [39051, 13198, 34281]
    assert [int(value(spark, T.xxh3(t, 32, s))) for s in (0, 42, -42)] == [1088854155, 3913102222, 3721037289]
    assert int(value(spark, T.xxh3(t))) == 15296390279056496779


def test_numbered_exam(spark):
    q, c = F.lit("3) Apa (a) itu? "), F.lit("A. satu\n\nB. dua tiga\nC. tiga")
    assert value(spark, templates.numbered_exam(q, c, F.lit(" tiga "))) == "Jawab soalan berikut.\nApa (a) itu?\n\nA. satu\nB. dua tiga\nC. tiga\nJawapan: B"
    assert value(spark, templates.numbered_exam(F.lit("no number"), c, F.lit("x"))).endswith("\n\n\nA. satu\nB. dua tiga\nC. tiga\nJawapan: None")


def test_nulls_and_fences(spark):
    null = F.lit(None).cast("string")
    assert value(spark, templates.by_lines(F.lit("a"), null)) is None
    assert value(spark, templates.fenced(null)) is None and value(spark, templates.fenced(F.lit("x ```y"))) == "x ```y"
    assert value(spark, T.transcript_rejected(null, F.lit("one two three"))) is True
    assert value(spark, templates.paired_lists(F.array(F.lit("a")), F.array(F.lit("b"), F.lit("c")))) is None


def test_flatten_lists_and_short_values(spark):
    record = json.dumps({"a_b": ["x", None, "y"], "n": None, "s": "q", "t": "[not a list"})
    assert value(spark, records.flatten_record(F.lit(record))) == "a b: x\nNone\ny\nn: None\ns: q\nt: [not a list"
    assert value(spark, records.flatten_record(F.lit(record), 3)) == "a b: x\nNone\ny\nn: None\nt: [not a list"


def test_product_page(spark):
    page = '<div class="x bloc-title">A <b>b</b></div><div class="descriptif">d<div>e</div></div><div class="descriptif">later</div>'
    reviews = '<div class="d-none">out</div><div class="bloc-reviews"><div class="d-none"> one </div><p>no</p><div class="d-none">two</div></div>'
    data = [(1, page, reviews), (2, page, "<p>none</p>"), (3, "<div class='bloc-title'>t</div>", reviews), (4, None, None)]
    got = {r["k"]: r["p"] for r in spark.createDataFrame(data, "k int, d string, r string").select("k", html.product_page(F.col("d"), F.col("r")).alias("p")).collect()}
    assert tuple(got[1]) == ("A b", "de", ["one", "two"]) and tuple(got[2]) == ("A b", "de", None) and got[3] is None and got[4] is None


def test_tokenizer_round_trip(spark):
    texts = ["<s>plain text</s>", "é … 漢 🤦", "", None]
    special = ("<s>", "</s>")
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k int, t string").withColumn("ids", tokenizers.encode(F.col("t"), VOCABULARY, special))
    got = {r["k"]: r for r in df.select("k", "ids", tokenizers.decode(F.col("ids"), VOCABULARY, special).alias("back")).collect()}
    assert [got[i]["back"] for i in range(4)] == texts
    assert got[0]["ids"][0] == 50257 and got[0]["ids"][-1] == 50258


def test_singletons_by_brute_force(spark):
    rng = np.random.default_rng(5)
    edges = sorted({(int(min(a, b)), int(max(a, b))) for a, b in rng.integers(0, 40, (50, 2)) if a != b})
    near, claimed, alone = set(edges), set(), []
    for i in range(40):
        if i in claimed:
            continue
        own = [j for j in range(i + 1, 40) if j not in claimed and (i, j) in near]
        claimed.update(own)
        if not own:
            alone.append(i)
    ids = spark.range(40).select(F.col("id").alias("vec_id"))
    assert sorted(r[0] for r in vectors.singletons(ids, spark.createDataFrame(edges, "i long, j long")).collect()) == alone


@pytest.mark.parametrize(("hash_func", "bits"), [("xxh3", 64), ("sha1", 32), ("xxh3", 16)])
def test_signature_options(spark, hash_func, bits):
    docs = spark.createDataFrame([(1, "a b c d e f g"), (2, "A b c d e f g"), (3, "q w e r t y")], "doc_id long, text string")
    sig = {r["doc_id"]: r["sig"] for r in near_dup.signatures(docs, 16, hash_func=hash_func, bits=bits).collect()}
    assert sig[1] == sig[2] != sig[3] and max(map(max, sig.values())) < 1 << min(bits, 32)
    assert {r["cluster"] for r in near_dup.cluster(docs, 0.7, hash_func=hash_func, bits=bits).collect()} == {1, 3}


def test_reports_and_manifest(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(5)], "doc_id long, text string")
    clusters = spark.createDataFrame([(0, 0), (1, 1), (2, 1), (3, 3), (4, 1)], "doc_id long, cluster long")
    io.write_reports(docs, clusters, f"{tmp_path}/r")
    assert [tuple(r) for r in spark.read.csv(f"{tmp_path}/r/duplicates_pair", header=True).collect()] == [("1", "[1, 2, 4]")]
    assert sorted((r["doc_id"], r["__cluster__"], r["text"]) for r in spark.read.json(f"{tmp_path}/r/duplicates_cluster").collect()) == [(1, 1, "t1"), (2, 1, "t2"), (4, 1, "t4")]
    assert near_dup.rows_of_cluster(docs, clusters, 3).count() == 1
    done = f"{tmp_path}/done"
    assert io.not_done(docs, done, "doc_id").count() == 5
    io.mark_done(docs.where("doc_id < 3"), done, "doc_id")
    assert sorted(r["doc_id"] for r in io.not_done(docs, done, "doc_id").collect()) == [3, 4]


def test_parts_merge_and_streams(spark, tmp_path):
    df = spark.range(10).select("id")
    io.write_parts(df, f"{tmp_path}/p", ["id"], 4)
    assert {(r["part"], r["count"]) for r in spark.read.json(f"{tmp_path}/p").groupBy("part").count().collect()} == {(0, 4), (1, 4), (2, 2)}
    folders = [f"{tmp_path}/b-10", f"{tmp_path}/b-9"]
    for k, f in enumerate(folders):
        io.write_blocks(spark.createDataFrame([(k, [k, k])], "n int, tokens array<int>"), f, 10)
    io.merge_blocks(spark, folders, f"{tmp_path}/all", 10)
    assert {(r["shard"], r["n"]) for r in spark.read.parquet(f"{tmp_path}/all").collect()} == {(0, 1), (1, 0)}
    t = pa.table({"x": pa.array([1, 2, 3], pa.int64())})
    with pa.OSFile(f"{tmp_path}/s.arrow", "wb") as sink, pa.ipc.new_stream(sink, t.schema) as w:
        w.write_table(t, max_chunksize=2)
    assert sorted(r["x"] for r in io.arrow_stream(spark, f"{tmp_path}/s.arrow", "x long").collect()) == [1, 2, 3]
    assert [r["bytes"] > 0 for r in io.file_sizes(spark, f"{tmp_path}/s.arrow").collect()] == [True]


def test_readers(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([json.dumps({"t": "x"}), json.dumps({"t": None})]))
    assert [r["t"] for r in io.json_array(spark, f"{tmp_path}/a.json", "t string").collect()] == ["x", None]
    (tmp_path / "c.csv").write_text("a,b,c\n1,2,3\n")
    assert io.csv_without_last(spark, f"{tmp_path}/c.csv").columns == ["a"]
    (tmp_path / "l.txt").write_bytes("caf\xe9".encode("latin-1"))
    assert io.legacy_text(spark, f"{tmp_path}/l.txt").first()[0] == "café"
    np.save(f"{tmp_path}/v.npy", np.array([1.5, 2.0]))
    assert io.npy_matrix(spark, f"{tmp_path}/v.npy").first()["embedding"] == [1.5, 2.0]
    (tmp_path / "h.txt").write_text("1\n2\n3\n")
    assert io.head_of_files(spark, f"{tmp_path}/h.txt", 2).count() == 2


@pytest.mark.parametrize("tokenizer", [None, VOCABULARY])
def test_recipe_runs(spark, tmp_path, tokenizer):
    docs = spark.createDataFrame([(i, "s", " ".join(f"w{i}x{j}" for j in range(3000))) for i in range(2)] + [(2, "s", " ".join(f"w0x{j}" for j in range(3000))), (3, "s", None), (4, "s", "404 Not Found")], "doc_id long, source string, text string")
    sizes = {r["stage"]: r["n"] for r in recipes.run(spark, "llama-v2", docs, str(tmp_path), tokenizer).collect()}
    assert sizes["raw"] == 5 and sizes["chunks"] == 12
    name = "llama-v1" if tokenizer else "mistral"
    out = recipes.blocks(spark.read.parquet(f"{tmp_path}/chunks"), recipes.RECIPES[name], tokenizer).collect()
    assert out and all(len(r["tokens"]) == recipes.RECIPES[name].block for r in out)


@pytest.mark.parametrize("name", ["e1_pipeline", "e2_recipe_blocks"])
def test_texts_are_cleaned_once(spark, monkeypatch, name):
    """No plan before the first cut of packing holds the cleaning twice, as a filter does that goes before the shuffle."""
    from conftest import SMALL

    from corpusforge.operators import packing
    from corpusforge.plans.instructions import query  # noqa: F401  (registers the recipe)
    from corpusforge.plans.catalogue import QUERIES

    plans = []
    monkeypatch.setattr(packing, "cut", lambda df, real=packing.cut: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or real(df))
    assert QUERIES[name](spark, SMALL).count() > 0
    assert [p.count("{6,}") for p in plans] == [2]  # one run of blanks and one of dots
