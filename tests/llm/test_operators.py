import collections
import hashlib
import random
import re

import numpy as np
import pytest
from conftest import SMALL, oracle_rows, rows
from pyspark.sql import functions as F

from corpusforge.llm import chat, compact_windows, decontaminate, jump, langid, mixing, ngram_join, quality, queries, style_tree, substring_exact
from corpusforge.llm.common import Scratch, cut
from corpusforge.llm.suffixes import suffix_ranks

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, _row string, shard string, _key int, target string, _offset string"
WORD = re.compile("[^\x20\x09-\x0d]+")


def frame(spark, texts):
    """Documents with columns whose names clash with the operators' own."""
    data = [(i if i % 5 else None if i == 20 else i, t, "en" if i % 3 else None, f"s{i % 3}" if i % 4 else None, len(t or ""), 1, "x", "y", 2, "z", "o") for i, t in enumerate(texts)]
    return spark.createDataFrame(data, DOCS)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(400)]
    base = [" ".join(rng.choices(vocab, k=rng.choice([3, 25, 60, 120]))) for _ in range(24)]
    near = [re.sub(r"^\S+ \S+", "other start", b) for b in base[:8]]
    return [None, "", " \n\t", "one", "a b c d", "rep " * 3000, "#*$%" * 30, "same line here\n" * 9, "é 漢字 🤦 " * 12, *base, *near, *base[:5], "x" * 5000]


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_rows_as_sql(spark, duck, name):
    assert rows(queries.queries()[name](spark, SMALL)) == oracle_rows(duck, queries.oracle_sql()[name])


@pytest.mark.parametrize("run", [mixing.mix_report, mixing.mix_documents, jump.shard_documents, compact_windows.find_passages, quality.score_documents, quality.keep_documents, substring_exact.remove_repeats, ngram_join.link_documents, ngram_join.keep_one, langid.identify_documents])
def test_odd_rows_and_empty_tables(spark, texts, run):
    docs = frame(spark, texts)
    assert run(docs.limit(0)).collect() == []
    out = run(docs).collect()
    if run not in (compact_windows.find_passages, mixing.mix_documents, quality.keep_documents, ngram_join.keep_one):
        assert len(out) == len(texts)
    if run in (mixing.mix_documents, quality.keep_documents, ngram_join.keep_one):
        assert run(docs).columns == docs.columns


def _sets(texts):
    out = []
    for t in texts:
        w = WORD.findall((t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
        out.append(({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)}) if w else set())
    return out


def _groups(texts):
    sets = _sets(texts)
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    return label


@pytest.mark.parametrize("config", [ngram_join.JoinConfig(), ngram_join.JoinConfig(unit_shingles=400, frequent_in_split=1, frequent_list=50, pair_bucket=2)])
def test_join_is_brute_force(spark, texts, config):
    rng = random.Random(8)
    star = " ".join(f"v{i}" for i in range(80)).split()
    copies = [" ".join(w if rng.random() > 0.02 else "zz" for w in star) for _ in range(30)]
    all_texts = texts + copies + [" ".join(star)]
    docs = spark.createDataFrame(list(enumerate(all_texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.link_documents(docs, config).collect()}
    label, sets = _groups(all_texts), _sets(all_texts)
    assert got == {i: (len(sets[i]), label[i]) for i in range(len(all_texts))}


def test_join_of_crowded_blocks_is_brute_force(spark, texts):
    config = ngram_join.JoinConfig(unit_shingles=400, frequent_in_split=1, frequent_list=50, pair_bucket=2, pairs_per_seat=0)
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.link_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), config).collect()}
    assert got == dict(enumerate(_groups(texts)))


def test_crowded_buckets_join_no_blocks_by_chance(spark):
    # 200 classes of their own meet a block of 100 in one bucket each, and each other in a bucket of 200: no pair has enough in common.
    seats = [(1, k, 400, k) for k in range(200)] + [(2 + j, 1000 + i, 400, 1000) for j in range(2) for i in range(100)] + [(2 + j, k, 400, k) for j in range(2) for k in range(100 * j, 100 * j + 100)]
    # Two classes outside of the block share all that a pair is asked for, in buckets of the block.
    seats += [(10 + j, k, 40, k) for j in range(11) for k in (5000, 5001)] + [(10 + j, 1000 + i, 400, 1000) for j in range(11) for i in range(100)]
    own = spark.createDataFrame(seats, "h long, k1 long, n int, g long")
    got = {tuple(r) for r in ngram_join.across_pairs(own, ngram_join.JoinConfig(pairs_per_seat=60), ngram_join.Scratch(spark)).collect()}
    assert got == {(5000, 5001)}
    joined = {tuple(r) for r in ngram_join.across_pairs(own, ngram_join.JoinConfig(pairs_per_seat=0), ngram_join.Scratch(spark)).collect()}
    assert {(k, 0) for k in range(1, 200)} <= joined and (5001, 1000) in joined and (5000, 1000) in joined


def test_crowded_buckets_deal_out_no_chain_of_blocks(spark, monkeypatch):
    # Each text has a passage in common with those of its group and one with those of the next group; none link but copies.
    rng = random.Random(31)
    data = [" ".join([*(f"p{k}_{i}" for i in range(16)), *(f"o{rng.random()}" for _ in range(120)), *(f"p{(k + 1) % 60}_{i}" for i in range(16))]) for k in range(60) for _ in range(3)]
    data += [re.sub(r"^\S+", "other", t) for t in data[:4]]
    dealt = []

    def spy(df):
        out = cut(df)
        if "_units" in df.columns:
            dealt.append(out.agg(F.sum(F.size("_units"))).first()[0])
        return out

    monkeypatch.setattr(ngram_join, "cut", spy)
    config = ngram_join.JoinConfig(unit_shingles=2000, frequent_list=0, pair_bucket=2, pairs_per_seat=0)
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.link_documents(spark.createDataFrame(list(enumerate(data)), "doc_id long, text string"), config).collect()}
    assert got == dict(enumerate(_groups(data)))
    assert len(dealt) == 1 and dealt[0] < 1600, dealt


def test_the_most_frequent_shingles_are_those_a_count_admits(spark):
    counts = spark.createDataFrame([(h, n) for n, size in ((9, 3), (5, 4), (2, 10)) for h in range(100 * n, 100 * n + size)], "h long, n long")
    assert [len(ngram_join._most_frequent(counts, k)) for k in (2, 3, 6, 7, 16, 17)] == [0, 3, 3, 7, 7, 17]


def test_suffix_ranks(spark):
    rng = random.Random(1)
    strings = [[rng.randint(0, 2) for _ in range(rng.choice([1, 2, 3, 5, 9, 30]))] for _ in range(40)] + [[1] * 20, [1] * 20]
    df = spark.createDataFrame([(s, 7, j, x) for s, t in enumerate(strings) for j, x in enumerate(t)], "sid long, lane long, j long, name long")
    for need in (3, 9):
        rank = {(r["sid"], r["j"]): r["rank"] for r in suffix_ranks(df, need, Scratch(spark)).collect()}
        order = sorted(rank, key=rank.get)
        head = {k: strings[k[0]][k[1] :][:need] for k in rank}
        assert len(rank) == sum(map(len, strings))
        assert all(head[a] <= head[b] and (rank[a] != rank[b] or head[a] == head[b]) for a, b in zip(order, order[1:], strict=False))


@pytest.mark.parametrize("spacing", [6, 17])
def test_repeats_are_brute_force(spark, spacing):
    rng = random.Random(spacing)
    docs = [(i, "".join(rng.choice("abcde") for _ in range(rng.choice([0, 5, 60, 300])))) for i in range(30)]
    docs += [(100 + i, docs[i][1][rng.randint(0, 20) :] + docs[(7 * i) % 30][1][:70]) for i in range(30)]
    docs += [(200, "a" * 500), (201, "ab" * 200), (202, "é" * 150), (203, None), docs[3], docs[3]]
    length, count = 40, collections.Counter()
    raw = [(d, (t or "").encode()) for d, t in docs]
    for _, b in raw:
        count.update(b[i : i + length] for i in range(len(b) - length + 1))
    want = []
    for d, b in raw:
        gone = np.zeros(len(b), dtype=bool)
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                gone[i : i + length] = True
        rest = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        want.append((d, len(b), int(gone.sum()), int((np.diff(gone.astype(int), prepend=0) == 1).sum()), hashlib.sha256(rest).hexdigest()))
    out = substring_exact.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"), substring_exact.RepeatConfig(length=length, context=4, spacing=spacing))
    assert sorted(map(tuple, out.collect())) == sorted(want)


def test_passages_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    words = {r["doc_id"]: [w.lower() for w in WORD.findall(r["text"])] for r in docs.collect()}
    held = collections.defaultdict(set)
    for d, w in words.items():
        for i in range(len(w) - 49):
            held[tuple(w[i : i + 50])].add(d)
    truth = set().union(*[s for s in held.values() if len(s) > 1])
    out = compact_windows.find_passages(docs).collect()
    got = {r["doc_id"] for r in out} | {r["other_doc_id"] for r in out}
    assert len(truth - got) <= 0.01 * len(truth)
    for r in out:
        a, b = (_sets([" ".join(words[r[d]][r[s] : r[e]])])[0] for d, s, e in (("doc_id", "start_word", "end_word"), ("other_doc_id", "other_start", "other_end")))
        assert len(a & b) >= 0.75 * len(a | b)


def test_compact_windows_are_all(spark):
    rng = np.random.default_rng(2)
    v = rng.integers(0, 1 << 62, 60).astype(np.uint64)
    at = np.array([0, 25, 25, 60])
    got = set(zip(*(x.tolist() for x in compact_windows.windows(v, at, 7)), strict=True))
    want = set()
    for s, e in zip(at[:-1], at[1:], strict=True):
        for c in range(s, e):
            lo, hi = c, c
            while lo > s and v[lo - 1] > v[c]:
                lo -= 1
            while hi + 1 < e and v[hi + 1] > v[c]:
                hi += 1
            if hi - lo + 1 >= 7:
                want.add((lo, c, hi))
    assert got == want


def test_jump_moves_only_to_the_new_shard(spark):
    keys = spark.createDataFrame([(k, "t") for k in [*range(500), -5, 2**62, -(2**63), None]], "doc_id long, text string")
    out = jump.shard_documents(keys, 7).collect()

    def reference(key, n):
        key, b, j = (key or 0) % 2**64, -1, 0
        while j < n:
            b, key = j, (key * 2862933555777941757 + 1) % 2**64
            j = int((b + 1) * (2147483648.0 / ((key >> 33) + 1)))
        return b

    assert all(r["shard"] == reference(r["doc_id"], 7) and r["grown_shard"] == reference(r["doc_id"], 8) for r in out)
    for s in range(7):
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(sum(r["shard"] == s for r in out)))


def test_jump_takes_string_keys(spark):
    keys = spark.createDataFrame([(f"key {k}" if k else None, "t") for k in range(200)], "doc_id string, text string")
    out = jump.shard_documents(keys, 7).collect()
    assert {r["shard"] for r in out} == set(range(7)) and all(r["grown_shard"] in (r["shard"], 7) for r in out)


def test_mix_rows_hold_the_words_taken(spark, texts):
    docs = frame(spark, texts)
    report, mixed = mixing.mix_report(docs).collect(), mixing.mix_documents(docs).collect()
    assert sum(r["taken"] for r in report) == sum(len(WORD.findall(r["text"])) for r in mixed)
    assert all(r["taken"] <= 3 * r["size"] for r in report)
    assert sum(r["size"] for r in report) == pytest.approx(sum({(r["source_size"], r["target"]) for r in report} and [t for _, t in {(r["source_size"], r["target"]) for r in report}]), rel=1e-9)


def test_mix_cuts_one_text_per_source_at_a_word(spark, texts):
    docs = frame(spark, texts).withColumn("doc_id", F.coalesce("doc_id", F.lit(-1)))
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    cuts = [r for r in mixing.mix_documents(docs).collect() if r["text"] != text[r["doc_id"]]]
    assert all(text[r["doc_id"]].startswith(r["text"]) and WORD.findall(r["text"]) == WORD.findall(text[r["doc_id"]])[: len(WORD.findall(r["text"]))] for r in cuts)
    assert len(cuts) == len({r["source"] for r in cuts})


def test_leading_words_keep_white_space(spark):
    df = spark.createDataFrame([("\n a\t\tb \x0bc ", n) for n in (1, 2, 3)], "t string, n long")
    assert [r[0] for r in df.select(mixing.leading_words(F.col("t"), F.col("n"))).collect()] == ["\n a", "\n a\t\tb", "\n a\t\tb \x0bc"]


def test_contamination_on_odd_rows(spark, texts):
    long = " ".join(f"q{i}" for i in range(40))
    docs = frame(spark, [*texts, f"Before {long.upper()} after " + " ".join(f"z{i}" for i in range(3000)), long[:60]])
    items = spark.createDataFrame([(1, long, 0), (1, long, 0), (2, None, 0), (3, "", 0), (4, "a b c d", 0), (None, "one", 0)], "item_id long, text string, _hash int")
    got = sorted((r["doc_id"], r["item_id"]) for r in decontaminate.find_contaminated(docs, items).collect())
    assert [x for x in got if x[1] == 1] == [(len(texts), 1)] and (4, 4) in got and (3, None) in got
    assert decontaminate.find_contaminated(docs.limit(0), items).count() == decontaminate.find_contaminated(docs, items.limit(0)).count() == 0
    assert decontaminate.drop_contaminated(docs, items).count() == docs.count() - len({d for d, _ in got})


def test_hosts(spark):
    good, bad = " ".join(f"w{i}" for i in range(60)), "spam " * 60
    data = [(i, good, "clean") for i in range(200)] + [(1000 + i, bad if i % 10 else good, "bad") for i in range(200)] + [(3000, good, None)]
    out = {r["doc_id"]: r for r in quality.score_documents(spark.createDataFrame(data, "doc_id long, text string, source string")).collect()}
    assert all(out[i]["kept"] for i in range(200)) and not any(out[1000 + i]["kept"] for i in range(200)) and not out[1010]["base_failed"] and out[1010]["host_verdict"] == "blocked"
    assert out[1001]["n_repeat_words"] == 60 and out[3000]["n_words"] == 60


PAGE = """<!DOCTYPE html><html><head><title>t</title><script>var a = "</p><p>no</p>";</script></head><body><header><h1>Site</h1></header><nav><ul><li>Home</ul></nav>
<div class="cookie-banner">Accept</div><article><h1>Title &amp;&#233;</h1><p>One <b>bold
  text</b>.<p>Two<br>lines<div class="share">share me</div><blockquote>Quote</blockquote><form>mail</form></article><aside>side</aside><div id="comments"><p>first!</p></div><footer>(c)</footer>"""


def test_page_text(spark):
    assert style_tree.read_page(PAGE).text == "Title &é\nOne bold text.\nTwo lines\nQuote"
    assert [style_tree.read_page(x).text for x in (None, "", "<p")] == [""] * 3
    plain = "<body><div class=top><p>Follow us</p></div><div class=story><p>{}</p></div>"
    data = [(i, f"http://h.example/{i}", plain.format(f"story {i} " * 3)) for i in range(20)] + [(99, None, None), (99, None, None)]
    out = {r["page_id"]: r["text"] for r in style_tree.extract_pages(spark.createDataFrame(data, "page_id long, url string, html string")).collect()}
    assert out[3] == " ".join(["story 3"] * 3) and out[99] == ""


def test_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = langid.identify_documents(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert out > 0.98
    odd = spark.createDataFrame([(1, None, "en"), (2, "123 %%%", "en"), (3, "", None)], "doc_id long, text string, lang string")
    assert {(r["lang_pred"], r["score"]) for r in langid.identify_documents(odd).collect()} == {("und", 0.0)}


def test_long_conversations(spark):
    turns = [(1, t, "ann" if t % 3 else "bob", f"said {t}") for t in range(300)] + [(1, 300, "system", "note"), (2, 0, "system", "alone"), (None, 0, None, None), (None, 0, None, None)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    out = chat.rotate(df, chat.ChatConfig(part_turns=64, bucket_turns=50)).collect()
    assert {(r["conv_id"], r["speaker"]) for r in out} == {(1, "ann"), (1, "bob"), (None, "unknown")}
    for who in ("ann", "bob"):
        parts = sorted((r for r in out if r["speaker"] == who), key=lambda r: r["part"])
        assert [r["n_turns"] for r in parts] == [64, 64, 64, 64, 45]
        said = "".join(r["text"][m["start"] : m["end"]] for r in parts for m in r["masks"])
        assert said == "".join(f"{t[3]}<|im_end|>\n" for t in turns[:300] if t[2] == who)
    assert chat.rotate(df.limit(0)).collect() == []


def test_windows_do_not_depend_on_neighbours():
    rng = np.random.default_rng(3)
    a, b = (rng.integers(0, 40, n).astype(np.uint64) << np.uint64(40) for n in (300, 500))
    alone = set(zip(*(x.tolist() for x in compact_windows.windows(b, np.array([0, 500]), 10)), strict=True))
    both = set(zip(*(x.tolist() for x in compact_windows.windows(np.concatenate([a, b]), np.array([0, 300, 800]), 10)), strict=True))
    assert {(x - 300, c - 300, y - 300) for x, c, y in both if x >= 300} == alone


def test_busy_texts_are_cut_out_in_parts(spark):
    rng = random.Random(9)
    shared = " ".join(f"s{i}" for i in range(70))
    docs = [(i, " ".join([*(f"a{rng.random()}" for _ in range(30)), shared, *(f"b{rng.random()}" for _ in range(30))])) for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    whole, parts = (sorted(map(tuple, compact_windows.find_passages(df, compact_windows.WindowConfig(asks_per_part=k)).collect())) for k in (2000, 3))
    salted = compact_windows.find_passages(df, compact_windows.WindowConfig(hot_sample=1, hot_seen=2, salts=4)).collect()
    label = list(range(40))
    for r in salted:
        x, y = label[r["doc_id"]], label[r["other_doc_id"]]
        label = [x if z == y else z for z in label]
    assert len(set(label)) == 1
    assert whole == parts and {d for r in whole for d in (r[1], r[4])} == set(range(40))


def test_passages_on_both_sides_of_an_insertion(spark):
    rng = random.Random(12)
    docs, want = [], set()
    for k in range(60):
        x, y, z = ([f"{s}{k}_{rng.random()}" for _ in range(n)] for s, n in (("x", 150), ("y", 150), ("z", 200)))
        docs += [(2 * k, " ".join(x + y)), (2 * k + 1, " ".join(x + z + y))]
        want |= {(k, "x"), (k, "y")}
    got = set()
    for r in compact_windows.find_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect():
        start, end = (r["start_word"], r["end_word"]) if r["doc_id"] % 2 == 0 else (r["other_start"], r["other_end"])
        got |= {(r["doc_id"] // 2, side) for side, lo in (("x", 0), ("y", 150)) if start <= lo + 20 and end >= lo + 130}
    assert len(want - got) <= 2


def test_passages_do_not_depend_on_partitions(spark):
    rng = random.Random(13)
    shared = " ".join(f"s{i}" for i in range(70))
    texts = [" ".join([*(f"a{rng.random()}" for _ in range(rng.choice([0, 30]))), shared, *(f"b{rng.random()}" for _ in range(30))]) for _ in range(20)]
    df = spark.createDataFrame([(i, texts[i % 20]) for i in range(80)], "doc_id long, text string")
    config = compact_windows.WindowConfig(hot_sample=1, hot_seen=21, salts=4)
    one, many = (sorted(map(tuple, compact_windows.find_passages(df.repartition(k), config).collect())) for k in (1, 7))
    assert one == many and len(one) >= 79


def test_copies_of_a_page_keep_their_text(spark):
    page = "<html><body><div class=top><p>Follow us</p></div><div class=wrap><article><h1>Title</h1><p>Story {}</p></article></div></body></html>"
    data = [(i, "http://copies.example/a", page.format("one")) for i in range(40)] + [(100 + i, "http://copies.example/b", page.format(f"two {i}")) for i in range(2)]
    data += [(200 + i, "http://alike.example/a", page.format("one") + "<!-- " + str(i) + " -->") for i in range(9)]
    out = {r["page_id"]: r["text"] for r in style_tree.extract_pages(spark.createDataFrame(data, "page_id long, url string, html string")).collect()}
    assert out[0] == out[39] == out[200] == "Title\nStory one" and out[100] == "Title\nStory two 0"


def test_passages_that_the_least_text_does_not_match(spark):
    rng = random.Random(21)
    docs = []
    for k in range(20):
        base = [f"p{k}_{i}" for i in range(80)]
        for j in range(14):
            own = list(base)
            for i in rng.sample(range(80), 0 if j < 2 else 6):
                own[i] = f"e{rng.random()}"
            docs.append((100 * k + j, " ".join([*(f"a{rng.random()}" for _ in range(30)), *own, *(f"b{rng.random()}" for _ in range(30))])))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    plain, salted = (sorted(map(tuple, compact_windows.find_passages(df, compact_windows.WindowConfig(hot_sample=1, hot_seen=k, salts=4)).collect())) for k in (10**9, 4))
    assert sum(any({r[1], r[4]} == {100 * k, 100 * k + 1} for r in plain) for k in range(20)) >= 19
    assert plain == salted


def test_passages_that_no_head_of_a_group_has(spark):
    # A line of 49 words in 60 texts is no passage; with the 14 words before it, of which one is edited, it is one of two texts.
    rng = random.Random(41)
    line = [f"s{i}" for i in range(49)]
    docs = []
    for k in range(30):
        lead = [f"q{k}_{i}" for i in range(13)]
        docs += [(2 * k + j, " ".join([*(f"a{rng.random()}" for _ in range(30)), *lead, f"e{rng.random()}", *line, *(f"b{rng.random()}" for _ in range(30))])) for j in range(2)]
    got = {tuple(sorted((r["doc_id"], r["other_doc_id"]))) for r in compact_windows.find_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got <= {(2 * k, 2 * k + 1) for k in range(30)} and len(got) >= 29


def test_every_member_of_a_group_meets_a_head():
    rng = np.random.default_rng(3)
    sid = np.sort(rng.integers(-50, 50, 400))
    sketch = rng.integers(0, 128, (40, 16)).astype(np.int8)[rng.integers(0, 40, 400)]
    heads, linked, pairs = set(), set(), []
    for h, rows in compact_windows.group_heads(sid, sketch, 4, 6):
        heads.add(h)
        linked |= set(rows.tolist())
        pairs += [tuple(sorted((h, r))) for r in rows.tolist()]
    assert len(heads) > 4 and heads | linked == set(range(400)) and len(pairs) == len(set(pairs))
    assert all(sid[x] != sid[y] and (sketch[x] == sketch[y]).sum() >= 6 for x, y in pairs)
