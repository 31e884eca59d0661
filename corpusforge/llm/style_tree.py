"""Main text of web pages by a site style tree.

The DOMs of a host's pages are merged by path (tags with their class and id, numbers in them left out). An element's
presentations are the sequences of its children; a text node's features are the blocks of text at its path. Over the
``m`` pages of a host, a feature on ``n`` pages has the entropy ``log n / log m``, and a text node's importance is one
less the mean entropy of its different features: near one where each page says something else, near zero where all say
the same. An element's importance composes, over its branch, the entropy of its presentations and the importance of
the texts below it, weighted by their length. A branch is removed from every page of its host if neither it nor
anything in it that enough pages hold is important; what too few pages hold goes with the branch around it. Pages
that landmarks leave the same text are copies of one page there, so a page that is copied often does not make its own
text look like a menu.

Landmarks settle what the tree leaves: on small hosts, and where adverts or footers say something else on every page,
boilerplate looks as important as articles. Elements that declare themselves as menu, header, footer, sidebar, notice,
advert, form or comment go, and if a page marks its article or main part, only that is kept. The tree also removes
branches inside of a marked article, but not its plain headings, paragraphs and lists (those without class and id),
and never ``html``, ``body`` or what holds an article. ``TreeConfig.landmarks`` and ``TreeConfig.tree`` switch either.

Defined cases: a null or empty html gives an empty text; broken markup is read as far as it goes, an unclosed element
ends with its parent; a null or unparsable url counts as a host of its own kind; repeated rows each give a row and
count as one page; an empty table gives no rows; very long pages are read whole, and elements nested deeper than
``MAX_DEPTH`` count as their ancestor there. Columns other than ``page_id, url,
html`` are not read, so others may have any name.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusforge.llm.common import Scratch, cut, small


@dataclass(frozen=True)
class TreeConfig:
    #: Pages a node must be seen on before its entropy counts, and the importance below which its branch goes.
    min_pages: int = 8
    min_importance: float = 0.9
    #: Weight of an element's presentations against the texts of its branch.
    style_weight: float = 0.1
    #: Whether the tree, and whether landmarks, remove anything.
    tree: bool = True
    landmarks: bool = True
    #: Bytes of low branches that may be broadcast; beyond, pages are joined to them by host.
    broadcast_bytes: int = 64_000_000


_markup = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^\"'>]++|\"[^\"]*+\"|'[^']*+')*+)>|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)(?:>|\Z)", re.S)
_attr = re.compile(r"(?:^|\s)(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=\s|/|$)", re.I)
_token = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

_raw = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
_void = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_inline = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q ruby rt rp s samp small span strike strong sub sup time tt u var label".split())
_ends_p = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split())
_alike = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_holds = frozenset("ul ol dl table article section div body".split())
_gone = frozenset("nav footer aside form script style noscript template iframe button select textarea svg object canvas menu dialog head title input fieldset audio video math".split())
_roles = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
_noise = frozenset(
    "ad ads adv advert adverts advertisement advertising banner promo promotion sponsor sponsored sidebar cookie cookies consent gdpr notice notices notification popup modal overlay newsletter subscribe signup share sharing social comment comments commentlist respond reply replies disqus discussion breadcrumb breadcrumbs menu navbar navigation nav footer related recommended recommendations widget login search pagination pager toolbar copyright disclaimer skip".split()
)
_top = frozenset("header masthead topbar".split())
#: Elements whose text is none of the page's, whatever the tree says.
_never = frozenset("script style noscript template iframe textarea svg object canvas head title option datalist audio video math".split())
_digits = re.compile(r"[0-9]+")
_text = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre td th dd dt figcaption".split())


def _hash(*parts: str) -> int:
    return int.from_bytes(blake2b("\x1f".join(parts).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


#: Elements below this depth count as their ancestor there.
MAX_DEPTH = 64


def path_hash(*names: str) -> int:
    """Identifies the path of nested elements, from the outermost on."""
    path = 0
    for name in names:
        path = _hash(str(path), name)
    return path


class _Node:
    __slots__ = ("tag", "path", "noise", "low", "main", "kids", "holds", "plain", "inert")

    def __init__(self, tag: str, path: int, noise: bool, low: bool, main: bool, plain: bool = False, inert: bool = False):
        self.tag, self.path, self.noise, self.low, self.main, self.plain, self.inert = tag, path, noise, low, main, plain, inert
        self.kids: list[str] = []
        self.holds = False


def _is_noise(tag: str, attrs: dict[str, str], in_main: bool) -> bool:
    if tag in _gone or "hidden" in attrs or attrs.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", attrs.get("style", "")):
        return True
    if attrs.get("role", "").lower() in _roles:
        return True
    if tag in ("html", "body", "main"):
        return False
    own = {t.lower() for name in ("class", "id") for t in _token.findall(attrs.get(name, ""))}
    return bool(own & _noise) or not in_main and (tag == "header" or bool(own & _top))


def path_of_text(path: int) -> int:
    """Identifies the text that an element holds itself."""
    return _hash(str(path), "#text")


@dataclass
class Page:
    """What was read of a page: its text, and how many blocks the tree, and landmarks alone, took from it."""

    text: str
    by_tree: int
    by_landmark: int


@dataclass
class Seen:
    """What the tree learns from a page: ``(path, children, stays)`` of its elements, ``(path, block)`` of its texts,
    and the ancestors of each path."""

    elements: list
    texts: list
    above: dict


def read_page(html: str | None, low: frozenset[int] = frozenset(), seen: Seen | None = None, landmarks: bool = True) -> Page:
    """Reads a page. ``low``: hashes of paths whose branches go. ``seen`` is filled if it is given."""
    html = html or ""
    root = _Node("", 0, False, False, False)
    stack, blocks, piece = [root], [], []
    depth = 0

    def flush() -> None:
        text = " ".join("".join(piece).split())
        piece.clear()
        if text:
            top = stack[-1]
            own = next((n for n in reversed(stack) if n.path), root)
            if own.inert:
                return
            blocks.append((top.main, top.noise, own.low or bool(low) and not own.plain and path_of_text(own.path) in low, text))
            if seen is not None:
                seen.texts.append((own.path, text))

    def close() -> None:
        nonlocal depth
        n = stack[-1]
        if n.tag not in _inline:
            flush()
        stack.pop()
        depth -= n.path != 0
        if n.holds or n.main and not stack[-1].main:
            stack[-1].holds = True
        if seen is not None and n.path and not n.inert:
            seen.elements.append((n.path, _hash(*n.kids), n.holds or n.tag in ("html", "body")))

    def add(raw: str) -> None:
        if raw:
            piece.append(entities.unescape(raw) if "&" in raw else raw)

    at, size = 0, len(html)
    while at < size:
        m = _markup.search(html, at)
        if m is None:
            add(html[at:])
            break
        add(html[at : m.start()])
        at = m.end()
        if m["cdata"] is not None:
            piece.append(m["cdata"])
            continue
        tag = (m["tag"] or m["tag2"] or "").lower()
        if not tag:
            continue
        if m["end"] or m["end2"]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    while len(stack) > k:
                        close()
                    break
                if tag in _inline and stack[k].tag not in _inline:
                    break
            continue
        if tag in _void:
            if tag == "hr":
                flush()
            elif tag in ("br", "wbr", "img"):
                piece.append(" " if tag == "br" else "")
            continue
        if tag in _ends_p:
            k = len(stack) - 1
            while k and stack[k].tag in _inline:
                k -= 1
            if stack[k].tag == "p":
                while len(stack) > k:
                    close()
        elif tag in _alike:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in _alike[tag]:
                    while len(stack) > k:
                        close()
                    break
                if stack[k].tag in _holds:
                    break
        raw_attrs = m["attrs"] or m["attrs2"] or ""
        attrs = {a.lower(): entities.unescape(x or y or z or "") for a, x, y, z in _attr.findall(raw_attrs)} if len(raw_attrs) > 3 else {}
        up = stack[-1]
        noise = up.noise or landmarks and _is_noise(tag, attrs, up.main) or tag in _never
        if tag in _inline:
            if noise != up.noise:
                flush()
            stack.append(_Node(tag, 0, noise, up.low, up.main, up.plain, up.inert))
        else:
            flush()
            labels = [f".{_digits.sub('', attrs[a])}" for a in ("class", "id") if attrs.get(a)]
            name = tag + "".join(labels)
            holder = next((n for n in reversed(stack) if n.path), root)
            holder.kids.append(name)
            path = _hash(str(holder.path), name) if depth < MAX_DEPTH else holder.path
            main = up.main or landmarks and (tag in ("article", "main") or attrs.get("role") in ("main", "article"))
            plain = main and tag in _text and not labels
            exempt = tag in ("html", "body") or main and (plain or not up.main)
            gone = up.low or bool(low) and not exempt and path in low
            inert = up.inert or tag in _never
            stack.append(_Node(tag, path, noise, gone, main, plain, inert))
            depth += 1
            if seen is not None and not inert and path not in seen.above:
                seen.above[path] = {n.path for n in stack if n.path}
        if tag in _raw:
            end = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(html, at)
            at = end.start() if end else size
        elif raw_attrs.endswith("/") and tag in ("svg", "path", "math"):
            close()
    flush()
    while len(stack) > 1:
        close()
    clean = [(main, text) for main, noise, is_low, text in blocks if not noise and not is_low]
    kept = [t for main, t in clean if main] if any(x[0] for x in blocks) else [t for _, t in clean]
    by_tree = sum(x[2] for x in blocks)
    return Page("\n".join(kept), by_tree, len(blocks) - by_tree - len(kept))


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``_host, kind, path, value, page, chars``: presentations (kind 0) and text blocks (1) of pages, and once a
    task the ancestors of each path (2) and the paths that always stay (3)."""
    told: set = set()
    for b in batches:
        rows: dict = {}
        for host, page in zip(b.column("_host").to_pylist(), b.column("html").to_pylist(), strict=True):
            seen = Seen([], [], {})
            key = _hash(read_page(page, seen=seen).text) >> 32
            for path, kids, stays in seen.elements:
                rows[host, 0, path, kids, key] = 0
                if stays and (host, path, 3) not in told:
                    told.add((host, path, 3))
                    rows[host, 3, path, 0, 0] = 0
            for path, text in seen.texts:
                rows[host, 1, path_of_text(path), _hash(text), key] = len(text)
                if (host, path, 1) not in told:
                    told.add((host, path, 1))
                    for up in [path, path_of_text(path), *seen.above.get(path, ())]:
                        rows[host, 2, path_of_text(path), up, 0] = 0
            for path, above in seen.above.items():
                if (host, path, 2) not in told:
                    told.add((host, path, 2))
                    for up in above:
                        rows[host, 2, path, up, 0] = 0
            if len(told) > 500_000:  # told again, which changes nothing
                told.clear()
        if rows:
            keys = list(zip(*rows, strict=True))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays([*(pa.array(k, t) for k, t in zip(keys, kinds, strict=True)), pa.array(list(rows.values()), pa.int32())], names=["_host", "kind", "path", "value", "page", "chars"])


def style_tree(pages: DataFrame, config: TreeConfig = TreeConfig()) -> DataFrame:
    """``_host, kind, path, pages, importance, best, stays``: the nodes of every host's tree. ``kind`` is 0 for an
    element and 1 for a text node; ``best`` is the largest importance in the node's branch, itself included."""
    c = config
    rows = pages.select("_host", "html").mapInArrow(_learn, "_host long, kind int, path long, value long, page int, chars int")
    tmp = Scratch(pages.sparkSession)
    rows = tmp.keep(rows.groupBy("_host", "kind", "path", "value", "page").agg(F.max("chars").alias("chars")), "rows")
    said = rows.where("kind < 2")
    count = F.count(F.lit(1)).cast("double")
    # A host's pages are broadcast to its features, which are not dealt by host.
    sizes = small(cut(said.select("_host", "page").distinct().groupBy(F.col("_host").alias("_h")).agg(count.alias("m"))))
    on_pages = said.groupBy("_host", "kind", "path").agg(F.count_distinct("page").alias("pages"))
    features = said.groupBy("_host", "kind", "path", "value").agg(count.alias("n"), F.sum("chars").alias("chars")).join(sizes, F.col("_host") == F.col("_h"))
    n, m = F.col("n"), F.greatest(F.col("m"), F.lit(2.0))
    per_node = features.groupBy("_host", "kind", "path").agg(
        F.avg(1 - F.log(n) / F.log(m)).alias("content"),
        # The entropy of n_1, n_2, ... is log N - sum(n log n) / N, here to the base of the host's pages.
        ((F.log(F.sum("n")) - F.sum(n * F.log(n)) / F.sum("n")) / F.log(F.max(m))).alias("style"),
        F.sum("chars").alias("chars"),
    )
    nodes = cut(per_node.join(on_pages, ["_host", "kind", "path"]))
    above = rows.where("kind = 2").select("_host", "path", F.col("value").alias("up"))
    known = F.col("pages") >= c.min_pages
    texts = nodes.where((F.col("kind") == 1) & known).select("_host", "path", "chars", "content")
    mean = F.sum(F.col("content") * F.col("chars")) / F.sum("chars")
    branch = above.join(texts, ["_host", "path"]).groupBy("_host", F.col("up").alias("path")).agg(mean.alias("said"))
    importance = F.when(F.col("kind") == 1, F.col("content")).otherwise(c.style_weight * F.col("style") + (1 - c.style_weight) * F.col("said"))
    rated = cut(nodes.join(branch, ["_host", "path"], "left").select("_host", "kind", "path", "pages", importance.alias("importance")))
    best = above.join(rated.where(known).select("_host", "path", "importance"), ["_host", "path"]).groupBy("_host", F.col("up").alias("path")).agg(F.max("importance").alias("best"))
    stays = rows.where("kind = 3").select("_host", "path", F.lit(True).alias("stays"))
    tree = cut(rated.join(best, ["_host", "path"], "left").join(stays, ["_host", "path"], "left").withColumn("stays", F.coalesce("stays", F.lit(False))))
    tmp.drop("rows")
    return tree


def low_branches(pages: DataFrame, config: TreeConfig = TreeConfig()) -> DataFrame:
    """``_host, _low``: hashes of the paths of each host whose branches have little importance."""
    low = style_tree(pages, config).where((F.col("pages") >= config.min_pages) & (F.col("best") < config.min_importance) & ~F.col("stays"))
    return low.groupBy("_host").agg(F.sort_array(F.collect_set("path")).alias("_low"))


def _extract(batches: Iterator[pa.RecordBatch], landmarks: bool) -> Iterator[pa.RecordBatch]:
    for b in batches:
        pages = [read_page(h, frozenset(low or ()), None, landmarks) for h, low in zip(b.column("html").to_pylist(), b.column("_low").to_pylist(), strict=True)]
        texts = [p.text for p in pages]
        counts = [pa.array(x, pa.int64()) for x in ([len(t) for t in texts], [p.by_tree for p in pages], [p.by_landmark for p in pages])]
        yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), *counts], names=["page_id", "url", "text", "n_chars", "n_low_blocks", "n_marked_blocks"])


def extract_pages(pages: DataFrame, config: TreeConfig = TreeConfig()) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page, and the blocks that the tree (``n_low_blocks``), and that
    landmarks alone (``n_marked_blocks``), took from it."""
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    known = pages.select("page_id", "url", "html", F.xxhash64(host).alias("_host"))
    if config.tree:
        low = cut(low_branches(known, config).withColumnRenamed("_host", "_of"))
        size = low.agg(F.sum(F.size("_low") * 8 + 32)).first()[0] or 0
        joined = known.join(F.broadcast(low) if size <= config.broadcast_bytes else low, F.col("_host") == F.col("_of"), "left")
    else:
        joined = known.withColumn("_low", F.lit(None).cast("array<bigint>"))
    return joined.select("page_id", "url", "html", "_low").mapInArrow(lambda it: _extract(it, config.landmarks), "page_id long, url string, text string, n_chars long, n_low_blocks long, n_marked_blocks long")
