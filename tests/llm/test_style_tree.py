import collections
import math
import random

import pytest

from corpusforge.llm import style_tree
from corpusforge.llm.style_tree import TreeConfig, extract_pages, path_hash, path_of_text, read_page

SCHEMA = "page_id long, url string, html string, text string, _host string, n_chars int, path string, _low string"


def frame(spark, pages):
    return spark.createDataFrame([(*p, "x", "y", 1, "z", "w") for p in pages], SCHEMA)


def _site(n, seed):
    """Pages without landmarks: where each block stands, and the html."""
    rng = random.Random(seed)
    menu = [f"menu {i}" for i in range(4)]
    out = []
    for i in range(n):
        blocks = [("ul/li", m) for m in menu] + [("div.x", f"box {rng.randint(0, 3)}")]
        blocks += [("div.y/p", f"story {seed} {i} {k} " + "word " * rng.randint(5, 30)) for k in range(rng.randint(1, 6))]
        blocks += [("div.y/div.z", f"tell a friend {rng.randint(0, 2)}"), ("div.w", "the end")]
        story = "".join(f"<p>{t}</p>" for w, t in blocks if w == "div.y/p")
        by = {w: [t for v, t in blocks if v == w] for w, _ in blocks}
        html = "<html><body><ul>" + "".join(f"<li>{m}</li>" for m in menu) + f"</ul><div class=x>{by['div.x'][0]}</div><div class=y>{story}<div class=z>{by['div.y/div.z'][0]}</div></div><div class=w>the end</div></body></html>"
        out.append((blocks, html))
    return out


def _path(where):
    return path_hash("html", "body", *where.split("/"))


def test_importance_is_brute_force(spark):
    site = _site(40, 1)
    df = frame(spark, [(i, "http://a.example/x", h) for i, (_, h) in enumerate(site)])
    got = {(r["kind"], r["path"]): r for r in style_tree.style_tree(df.withColumn("_host", df["page_id"] * 0)).collect()}
    m = len(site)
    on, chars = collections.defaultdict(lambda: collections.defaultdict(set)), collections.Counter()
    for i, (blocks, _) in enumerate(site):
        for where, text in dict.fromkeys((w, " ".join(t.split())) for w, t in blocks):
            on[where][text].add(i)
            chars[where] += len(text)
    content = {w: sum(1 - math.log(len(p)) / math.log(m) for p in f.values()) / len(f) for w, f in on.items()}
    for where, value in content.items():
        r = got[1, path_of_text(_path(where))]
        assert r["importance"] == pytest.approx(value) and r["pages"] == m
    styles = collections.Counter(tuple(["p"] * sum(w == "div.y/p" for w, _ in b) + ["div.z"]) for b, _ in site)
    style = -sum(v / m * math.log(v / m) for v in styles.values()) / math.log(m)
    below = ["div.y/p", "div.y/div.z"]
    said = sum(content[w] * chars[w] for w in below) / sum(chars[w] for w in below)
    y = got[0, _path("div.y")]
    assert y["importance"] == pytest.approx(0.1 * style + 0.9 * said)
    assert y["best"] == pytest.approx(max(y["importance"], *(got[0, _path(w)]["importance"] for w in below), *(content[w] for w in below)))


def test_tree_alone_finds_the_story(spark):
    site = _site(60, 2)
    df = frame(spark, [(i, "http://a.example/x", h) for i, (_, h) in enumerate(site)])
    want = {i: "\n".join(" ".join(t.split()) for w, t in b if w == "div.y/p") for i, (b, _) in enumerate(site)}
    for landmarks in (True, False):
        out = extract_pages(df, TreeConfig(landmarks=landmarks)).collect()
        assert {r["page_id"]: r["text"] for r in out} == want
        assert all(r["n_low_blocks"] == 7 and r["n_marked_blocks"] == 0 for r in out)
    off = extract_pages(df, TreeConfig(tree=False)).collect()
    assert not any(r["text"] == want[r["page_id"]] for r in off)


def test_low_branch_inside_a_marked_article(spark):
    page = "<body><nav>menu</nav><article><h2>References</h2><p>text {} of its own</p><div class=box>Like what you read? Tell all</div></article></body>"
    df = frame(spark, [(i, "http://b.example/x", page.format(i)) for i in range(30)])
    out = {r["page_id"]: r for r in extract_pages(df).collect()}
    assert all(out[i]["text"] == f"References\ntext {i} of its own" for i in range(30))


def test_odd_pages(spark):
    long = "<body><article>" + "".join(f"<p>word{i} and more</p>" for i in range(150_000)) + "</article></body>"
    data = [(1, "http://c.example/", long), (2, None, None), (2, None, None), (3, "no url", ""), (None, "http://[", "<p>text"), (5, "http://d.example/", "<div" * 2000), (6, "http://d.example/", "<div>" * 3000 + "deep")]
    out = {r["page_id"]: r for r in extract_pages(frame(spark, data)).collect()}
    assert extract_pages(frame(spark, data)).count() == len(data)
    assert out[1]["text"].count("\n") == 149_999 and out[1]["n_chars"] == len(out[1]["text"])
    assert out[2]["text"] == out[3]["text"] == "" and out[None]["text"] == "text" and out[6]["text"] == "deep"
    assert extract_pages(frame(spark, data).limit(0)).collect() == []


def test_all_text_without_tree_and_landmarks():
    page = read_page("<body><nav>menu</nav><p>a</p><footer>end</footer><script>x</script></body>", landmarks=False)
    assert (page.text, page.by_tree, page.by_landmark) == ("menu\na\nend", 0, 0)
