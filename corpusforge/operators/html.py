"""Paragraphs and text of HTML."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from corpusforge.checkpoint import lean_batches


class _Reader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.all: list[str] = []
        self.paragraphs: list[str] = []
        self.skip = self.open = 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.skip += 1
        elif tag == "p":
            self.paragraphs.append("")
            self.open = 1

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.skip = max(0, self.skip - 1)
        elif tag == "p":
            self.open = 0

    def handle_data(self, data):
        if not self.skip:
            self.all.append(data)
            if self.open:
                self.paragraphs[-1] += data


def _read(html: str | None) -> _Reader:
    r = _Reader()
    r.feed(html or "")
    r.close()
    return r


def html_paragraphs(html: Column) -> Column:
    """The text of every paragraph, one a line."""
    lean_batches(SparkSession.active())

    def run(pages: pd.Series) -> pd.Series:
        return pages.map(lambda h: "\n".join(_read(h).paragraphs))

    return F.pandas_udf(run, "string")(html)


def html_text(html: Column) -> Column:
    """Text read twice, which resolves markup that was escaped once more."""
    lean_batches(SparkSession.active())

    def run(pages: pd.Series) -> pd.Series:
        return pages.map(lambda h: "".join(_read("".join(_read(h).all)).all))

    return F.pandas_udf(run, "string")(html)


class _Classes(HTMLParser):
    """Text of ``div`` elements by class; ``found`` holds ``(class, start depth, text parts, depth of the box around)``."""

    def __init__(self, wanted: set[str]):
        super().__init__(convert_charrefs=True)
        self.wanted, self.depth, self.open, self.found = wanted, 0, [], []

    def handle_starttag(self, tag, attrs):
        if tag == "div":
            self.depth += 1
            names = set((dict(attrs).get("class") or "").split()) & self.wanted
            for name in sorted(names):
                hit = (name, self.depth, [], {n for n, *_ in self.open})
                self.open.append(hit)
                self.found.append(hit)

    def handle_endtag(self, tag):
        if tag == "div":
            self.open = [h for h in self.open if h[1] < self.depth]
            self.depth = max(0, self.depth - 1)

    def handle_data(self, data):
        for h in self.open:
            h[2].append(data)


def _boxes(html: str | None, *wanted: str) -> list[tuple[str, str, set[str]]]:
    r = _Classes(set(wanted))
    r.feed(html or "")
    r.close()
    return [(name, "".join(parts), inside) for name, _, parts, inside in r.found]


def product_page(description: Column, reviews: Column) -> Column:
    """``struct<title, description, reviews>`` of a product's two pages, by the classes of their boxes.

    Null without a title or a description; reviews are null without their box. Unclosed boxes reach to the end.
    """
    lean_batches(SparkSession.active())
    # Classes of the boxes.
    title, text, box, item = "bloc-title", "descriptif", "bloc-reviews", "d-none"
    # End of fixed values.

    def run(d: pd.Series, r: pd.Series) -> pd.DataFrame:
        out = []
        for page, side in zip(d, r, strict=True):
            got = _boxes(page, title, text)
            first = {n: next((t for k, t, _ in got if k == n), None) for n in (title, text)}
            boxes = _boxes(side, box, item)
            items = [t.strip() for k, t, inside in boxes if k == item and box in inside] if any(k == box for k, *_ in boxes) else None
            out.append((first[title], first[text], items))
        return pd.DataFrame(out, columns=["title", "description", "reviews"])

    page = F.pandas_udf(run, "title string, description string, reviews array<string>")(description, reviews)
    return F.when(page["title"].isNotNull() & page["description"].isNotNull(), page)
