import hashlib
import json

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusforge.functions import numeric
from corpusforge.functions import text as T
from corpusforge.operators import components, near_dup, packing, vectors
from corpusforge.operators.ordering import with_index
from corpusforge.sources import io


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "t string").select(column(F.col("t")).alias("x")).first()[0]


def test_golden_values(spark):
    assert numeric.band_shape(0.75, 256) == (21, 12)
    assert numeric.band_shape(0.75, 256, 0.1, 0.9) == (28, 9)
    assert numeric.band_shape(0.95, 256) == (5, 51)
    assert [numeric.span_lengths(n) for n in (512, 1024, 2048)] == [(568, 114), (1137, 229), (2274, 456)]
    assert one(spark, "hello world", T.sha1_low) == 896314922
    assert one(spark, " Hello, 123!\n\t\b", T.normalize_line) == "hello 000"
    pair = spark.createDataFrame([("hello world", "hello world!")], "a string, b string")
    assert pair.select(T.jaccard(T.char_ngrams(F.col("a"), 8), T.char_ngrams(F.col("b"), 8))).first()[0] == 0.8


def test_permutations():
    a, b = numeric.permutations(2)
    assert a.tolist() == [2297359619001564596, 1973689801170867272] and b.tolist() == [1396682528897996046, 1819927849474927636]
    assert numeric.minhash(np.zeros(0, dtype=np.uint64), a, b).tolist() == [(1 << 32) - 1] * 2


def test_clean(spark):
    assert one(spark, "  a" + " " * 7 + "b" + "." * 9 + "…" * 6 + "\n", T.clean) == "a   b..."
    assert one(spark, "x 404 Not Found", T.clean) is None
    assert one(spark, " a ", T.clean) is None
    assert one(spark, None, T.clean) is None


@settings(max_examples=20, deadline=None)
@given(st.text(max_size=40))
def test_strip_is_unicode_strip(spark, text):
    text = text.encode("utf-8", "ignore").decode()
    assert one(spark, text, T.strip) == text.strip()


def test_components_is_union_find(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 60, (45, 2))]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    got = {r["node"]: r["label"] for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in parent}


def test_packing_keeps_tokens(spark):
    docs = spark.createDataFrame([("a", 1, list(range(5))), ("a", 2, []), ("a", 3, list(range(5, 18))), ("b", 1, [1, 2, 3])], "k string, doc_id long, toks array<int>")
    got = {(r["k"], r["block"]): r["tokens"] for r in packing.pack(docs, F.col("toks"), 4, ["k"], ["doc_id"]).collect()}
    assert got == {("a", i): list(range(4 * i, 4 * i + 4)) for i in range(4)}
    with pytest.raises(Exception, match="does not fit"):
        spark.createDataFrame([(70000,)], "x long").select(packing.checked_cast(F.col("x"), 16)).collect()


def test_index_and_leaders(spark):
    df = spark.createDataFrame([(k % 2, k * 7 % 11) for k in range(11)], "g int, v int")
    assert sorted((r["v"], r["idx"]) for r in with_index(df, ["v"]).collect()) == [(i, i) for i in range(11)]
    ids = spark.createDataFrame([(i,) for i in range(6)], "vec_id long")
    edges = spark.createDataFrame([(0, 1), (1, 2), (2, 3), (4, 5)], "i long, j long")
    assert {r["vec_id"]: r["leader"] for r in vectors.leaders(ids, edges).collect()} == {0: 0, 1: 0, 2: 2, 3: 2, 4: 4, 5: 4}


def test_signature_of_empty(spark):
    docs = spark.createDataFrame([(1, None), (2, "a b"), (3, "a b c d e f")], "doc_id long, text string")
    sig = {r["doc_id"]: r["sig"] for r in near_dup.signatures(docs, 8).collect()}
    assert sig[1] == sig[2] == [(1 << 32) - 1] * 8 != sig[3]
    assert hashlib.sha1(b"x").digest()  # noqa: S324


def test_string_round_trip(spark, tmp_path):
    texts = ["plain", 'quote " and \\', "é … 漢 🤦", "line\nbreak\ttab", ""]
    io.write_strings(spark.createDataFrame([(t,) for t in texts], "text string"), str(tmp_path / "s"))
    lines = [r[0] for r in spark.read.text(str(tmp_path / "s")).collect()]
    assert all(x.isascii() for x in lines) and sorted(json.loads(x) for x in lines) == sorted(texts)
    (tmp_path / "bad.jsonl").write_text('"ok"\n{"a": 1}\nnot json\n')
    assert [r["text"] for r in io.jsonl_strings(spark, str(tmp_path / "bad.jsonl")).collect()] == ["ok"]
    assert [json.loads(r["value"]) for r in io.jsonl_objects(spark, str(tmp_path / "bad.jsonl")).collect()] == [{"a": 1}]


def test_cosine_edges_hold_no_tile_of_similarities(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(5)
    m = rng.integers(-3, 4, (400, 8)).astype(np.float32) + np.float32(0.0)
    m[:150] = m[0] + rng.integers(0, 2, (150, 8))  # a crowd, all of whose pairs are near
    m[np.abs(m).sum(axis=1) == 0] = 1
    df = spark.createDataFrame([(int(k), v.tolist()) for k, v in zip(rng.permutation(400), m, strict=True)] + [(400, None)], "vec_id long, embedding array<float>")
    import duckdb

    df.write.parquet(f"{tmp_path}/v")
    sql = "SELECT a.vec_id, b.vec_id FROM v a JOIN v b ON a.vec_id < b.vec_id WHERE list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.4"
    want = sorted(duckdb.sql(f"WITH v AS (FROM '{tmp_path}/v/*.parquet') {sql}").fetchall())
    assert sorted(tuple(r) for r in vectors.cosine_edges(df, 0.4).collect()) == want == sorted(tuple(r) for r in vectors.cosine_edges(df, 0.4, 1).collect())
    # blocks follow the table, so that a task's vectors stay as many
    monkeypatch.setattr(vectors, "BLOCK_NUMBERS", 8 * 20)
    placed = vectors.cosine_edges(df, 0.4)
    assert placed.rdd.getNumPartitions() == 20 * 21 // 2 and sorted(tuple(r) for r in placed.collect()) == want


def test_all_pairs_of_a_crowd_come_in_small_batches():
    m = np.ones((3000, 4))
    sizes = [len(i) for i, _ in vectors._near(np.arange(3000), m, 0, 0.4)]
    assert sum(sizes) == 3000 * 2999 // 2 and max(sizes) <= vectors.EDGES


def test_leaders_read_edges_of_open_ids_only(spark, monkeypatch):
    edges = [(i, i + 1) for i in range(12)] + [(0, j) for j in range(20, 40)]
    seen = []
    monkeypatch.setattr(vectors, "cut", lambda df, real=vectors.cut: seen.append(set(df.columns) == {"i", "j"} and df.count()) or real(df))
    ids = spark.createDataFrame([(i,) for i in range(40)], "vec_id long")
    got = {r["vec_id"]: r["leader"] for r in vectors.leaders(ids, spark.createDataFrame(edges, "i long, j long")).collect()}
    assert got == {i: i - i % 2 if i < 12 else 0 if i >= 20 else i for i in range(40)}
    sizes = [n for n in seen if n is not False]
    assert len(sizes) > 2 and sizes == sorted(sizes, reverse=True) and sizes[1] < 12 and sizes[-1] == 0


@settings(max_examples=200, deadline=None)
@given(*[st.text(alphabet="aab é漢🤦", max_size=30)] * 2, st.integers(1, 9))
def test_gram_jaccard_is_that_of_sets(a, b, n):
    from corpusforge.operators.pairs import gram_jaccard

    x, y = ({t} if len(t) < n else {t[i : i + n] for i in range(len(t) - n + 1)} for t in (a, b))
    assert gram_jaccard(a, b, n) == len(x & y) / len(x | y)


def test_gram_jaccard_of_many_letters():
    from corpusforge.operators.pairs import gram_jaccard

    a, b = "".join(map(chr, range(0x4E00, 0x7000))) * 2, "".join(map(chr, range(0x5000, 0x9000)))
    x, y = ({t[i : i + 8] for i in range(len(t) - 7)} for t in (a, b))
    assert gram_jaccard(a, b, 8) == len(x & y) / len(x | y)


def test_next_jaccard_over_range_ends(spark, duck, tmp_path):
    from corpusforge.operators.pairs import next_jaccard
    from corpusforge.plans import catalogue

    words = ["alpha beta", "gamma delta", "", "short", None, "漢字 alpha beta"]
    rows = [(i, [None, "x", "y"][i % 3 if i % 7 else 1], None if words[i % 6] is None else words[i % 6] + " same end of all texts" * (i % 2)) for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(4)
    df.write.parquet(f"{tmp_path}/d")
    want = duck.execute(catalogue.ORACLES["h7_jaccard_pairs"].replace("FROM documents", f"FROM '{tmp_path}/d/*.parquet'")).fetchall()
    for parts in ("1", "7"):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        old = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            got = [tuple(r) for r in next_jaccard(df, "source").collect()]
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", old)
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        key = lambda r: (r[0], r[1] is None, r[1])
        assert sorted(got, key=key) == sorted(want, key=key)


def test_minhash_stays_in_cache_and_divides_right():
    import tracemalloc

    a, b = numeric.permutations(256)
    h = np.random.default_rng(1).integers(0, 1 << 32, 20_000, dtype=np.uint64)
    tracemalloc.start()
    got = numeric.minhash(h, a, b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 << 20
    k = [int(v) for v in h[:300]]
    prime = (1 << 61) - 1
    want = lambda p, q: min((((v * int(p) + int(q)) % (1 << 64)) % prime) & 0xFFFFFFFF for v in k)
    assert numeric.minhash(h[:300], a, b).tolist() == [want(p, q) for p, q in zip(a, b, strict=True)] and (got <= numeric.minhash(h[:300], a, b)).all()
    edge = np.array([1, prime, prime - 1, prime], dtype=np.uint64), np.array([prime, prime - 1, prime, 3 * prime], dtype=np.uint64)
    k = [1]
    assert numeric.minhash(np.array([1], dtype=np.uint64), *edge).tolist() == [want(p, q) for p, q in zip(*edge, strict=True)]


def test_signatures_take_few_texts_at_once(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(key)
    spark.conf.set(key, 10_000)
    try:
        near_dup.signatures(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), 8)
        assert int(spark.conf.get(key)) <= 1000
    finally:
        spark.conf.set(key, was)


@pytest.mark.parametrize("read", ["html_paragraphs", "html_text"])
def test_pages_are_read_few_at_once(spark, read):
    from corpusforge.operators import html

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was = spark.conf.get(key)
    spark.conf.set(key, 10_000)
    try:
        got = spark.range(3000).coalesce(1).select(getattr(html, read)(F.concat(F.lit("<p>a &amp;lt;"), F.col("id").cast("string"))).alias("t"))
        assert int(spark.conf.get(key)) <= 1000
        assert {r["t"] for r in got.collect()} == {("a &lt;" if read == "html_paragraphs" else "a <") + str(i) for i in range(3000)}
    finally:
        spark.conf.set(key, was)


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_packing_over_range_ends(spark, parts):
    """Blocks that many partitions share, keys that end inside one, empty and null documents."""
    rng = np.random.default_rng(parts)
    rows = [(["a", None, "b", "c"][min(i // 60, 3)], i, None if i % 11 == 0 else [i * 100 + j for j in range(int(rng.integers(0, 9)) * (7 if i % 29 == 0 else 1))]) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, doc_id long, toks array<long>").repartition(5)
    want = {}
    for size in (1, 4, 50):
        for k in {r[0] for r in rows}:
            flat = [t for r in sorted(rows, key=lambda r: r[1]) if r[0] == k for t in r[2] or []]
            want |= {(size, k, b): flat[b * size : (b + 1) * size] for b in range(len(flat) // size)}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = [((size, r["k"], r["block"]), r["tokens"]) for size in (1, 4, 50) for r in packing.pack(df, F.col("toks"), size, ["k"], ["doc_id"]).collect()]
        as_words = F.transform("toks", lambda x: x.cast("string"))
        spelled = [((size, r["k"], r["block"]), [int(t) for t in r["tokens"]]) for size in (1, 50) for r in packing.pack(df, as_words, size, ["k"], ["doc_id"], words=True).collect()]
        placed = sorted((r["idx"], r["doc_id"]) for r in with_index(df, ["doc_id"]).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) == len(want) and dict(got) == want
    assert len(spelled) == len(dict(spelled)) and dict(spelled) == {k: v for k, v in want.items() if k[0] != 4}
    assert placed == [(i, i) for i in range(200)]


def test_packing_shuffles_texts_once(spark, tmp_path):
    df = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("a").alias("k"), F.array(F.col("id")).alias("toks"))
    packed = packing.pack(df, F.col("toks"), 4, ["k"], ["doc_id"])
    plan = packed._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan  # what is left after the one cut is a single pass
    assert packed.count() == 75


def test_words_are_kept_as_one_string(spark, monkeypatch):
    kinds = []
    monkeypatch.setattr(packing, "cut", lambda df, real=packing.cut: kinds.append(df.schema["_tokens"].dataType.simpleString()) or real(df))
    df = spark.createDataFrame([("a", 1, "x y z"), ("a", 2, " "), ("a", 3, None), ("a", 4, "q")], "k string, doc_id long, text string")
    from corpusforge.functions.text import tokens

    got = packing.pack(df, tokens(F.col("text")), 2, ["k"], ["doc_id"], words=True).collect()
    assert sorted((r["block"], *r["tokens"]) for r in got) == [(0, "x", "y"), (1, "z", "q")] and kinds == ["string"]
