"""Paragraphs of HTML pages by a real tokenizer, as a table function over partitions."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

_SKIP = {"script", "style", "nav", "head", "figcaption", "aside"}


class _Paragraphs(HTMLParser):
    """(kind, text, section, scene, link share) of headings and paragraphs; script, style and navigation are skipped."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows, self.section, self.scene = [], None, 0
        self.skip, self.kind, self.parts, self.linked, self.link = 0, None, [], 0, 0

    def _close(self):
        if self.kind:
            text = " ".join("".join(self.parts).split())
            if self.kind == "h2":
                self.section = text
            if text:
                self.rows.append((self.kind, text, self.section, self.scene, self.linked / max(1, len(text))))
        self.kind, self.parts, self.linked = None, [], 0

    def handle_starttag(self, tag, attrs):
        if tag in _SKIP:
            self.skip += 1
        elif tag == "hr":
            self.scene += 1
        elif tag in ("p", "h1", "h2", "h3", "li"):
            self._close()
            self.kind = tag
        elif tag == "br" and self.kind:
            self.parts.append(" ")
        elif tag == "a":
            self.link += 1

    def handle_endtag(self, tag):
        if tag in _SKIP:
            self.skip = max(0, self.skip - 1)
        elif tag == "a":
            self.link = max(0, self.link - 1)
        elif tag == self.kind or tag in ("article", "div", "body"):
            self._close()

    def handle_data(self, data):
        if self.kind and not self.skip:
            self.parts.append(data)
            if self.link:
                self.linked += len(" ".join(data.split()))

    def close(self):
        super().close()
        self._close()


def parsed(html: str | None) -> list[tuple]:
    p = _Paragraphs()
    p.feed(html or "")
    p.close()
    return p.rows


def paragraphs(pages: DataFrame, key: str, html: str, least: int = 1, links: float = 0.9) -> DataFrame:
    """A row per heading or paragraph: key, pos, kind, text, section (the last h2), scene (rules before it).

    Texts shorter than least and paragraphs that are links alone are left out; pages without any give no rows.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(k, i, *r[:4]) for k, h in zip(pdf[key], pdf[html]) for i, r in enumerate(x for x in parsed(h) if len(x[1]) >= least and x[4] < links)]
            yield pd.DataFrame(rows, columns=[key, "pos", "kind", "text", "section", "scene"])

    fields = T.StructType([pages.schema[key], *T.StructType.fromDDL("pos int, kind string, text string, section string, scene int").fields])
    return pages.select(key, html).mapInPandas(run, fields)


_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class _Elements(HTMLParser):
    """Rows [pos, tag, attributes, positions and tags of the elements around it, text, classes around it] of the wanted elements."""

    def __init__(self, wanted: frozenset[str], bare: frozenset[str], silent: frozenset[str]):
        super().__init__(convert_charrefs=True)
        self.wanted, self.bare, self.silent, self.rows, self.open, self.n = wanted, bare, silent, [], [], 0

    def handle_starttag(self, tag, attrs):
        around = self.open
        self.n += 1
        row = None
        if tag in self.wanted or tag in self.bare:
            row = [self.n, tag, {k: v or "" for k, v in attrs}, [x[0] for x in around], [x[1] for x in around], [], [x[3] for x in around]]
            self.rows.append(row)
        if tag not in _VOID:
            self.open = [*around, (self.n, tag, row[5] if tag in self.wanted else None, dict(attrs).get("class") or "")]

    def closed(self) -> list[list]:
        """Takes the rows to which nothing can be added any more."""
        still = {id(parts) for _, _, parts, _ in self.open if parts is not None}
        done = [r for r in self.rows if id(r[5]) not in still]
        self.rows = [r for r in self.rows if id(r[5]) in still]
        return done

    def handle_endtag(self, tag):
        last = max((i for i, x in enumerate(self.open) if x[1] == tag), default=None)
        if last is not None:
            self.open = self.open[:last]

    def handle_data(self, data):
        if not any(x[1] in self.silent for x in self.open):
            for _, _, parts, _ in self.open:
                if parts is not None:
                    parts.append(data)


#: Elements that go out together, and characters of a page that are parsed before those that are whole go out.
ROWS, PIECE = 5_000, 100_000


def pieces(page: str, size: int = PIECE) -> Iterator[str]:
    """The page cut before a '<' at size characters or later: no text between two tags is cut, so it parses as in one."""
    at = 0
    while at < len(page):
        cut = page.find("<", at + size)
        cut = len(page) if cut < 0 else cut
        yield page[at:cut]
        at = cut


def elements(pages: DataFrame, key: str, html: str, tags: list[str], bare: list[str] = (), silent: tuple[str, ...] = ("script", "style"), between: str = "", classes: bool = False) -> DataFrame:
    """A row per element of the tags: key, pos (its place in the page), tag, attrs, within (positions of the elements around
    it, outermost first), kinds (their tags) and text (of all that is inside but in silent tags, its pieces joined by `between`, white
    space collapsed; null for tags in bare); with `classes` also the class attribute of each element around it.

    What a page means is left to DataFrame operations on these rows. Null and empty pages have none.
    """
    wanted, no_text, quiet = frozenset(tags), frozenset(bare), frozenset(silent)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = []
        for pdf in batches:
            for k, h in zip(pdf[key], pdf[html]):
                p = _Elements(wanted, no_text, quiet)
                for piece in pieces(h or ""):
                    p.feed(piece)
                    rows += [(k, *r[:5], " ".join(between.join(r[5]).split()) if r[1] in wanted else None, *r[6:][:classes]) for r in p.closed()]
                    if len(rows) >= ROWS:
                        yield pd.DataFrame(rows, columns=[key, *more.names])
                        rows = []
                p.close()
                rows += [(k, *r[:5], " ".join(between.join(r[5]).split()) if r[1] in wanted else None, *r[6:][:classes]) for r in p.rows]
        if rows:
            yield pd.DataFrame(rows, columns=[key, *more.names])

    more = T.StructType.fromDDL("pos int, tag string, attrs map<string,string>, within array<int>, kinds array<string>, text string" + ", classes array<string>" * classes)
    fields = T.StructType([pages.schema[key], *more.fields])
    return pages.select(key, html).mapInPandas(run, fields)


#: Parts of a page that are no article, and elements that make its lines.
_AROUND, _LINES = ("script", "style", "nav", "header", "footer", "noscript"), ("h1", "h2", "h3", "h4", "p", "li")


def articles(pages: DataFrame, key: str, html: str, most: int = 20_000) -> DataFrame:
    """key and the text of each page's main article: the lines of its headings, paragraphs and list items, or all of its text if it
    has none; its first `most` characters.

    The article is the container with most text among the page's <article> elements (the first of equals), else its first <main>,
    else the page. A line belongs to every container around it. Navigation, headers and footers count nowhere. Pages without text give an empty one.
    """
    page = pages.select(key, F.concat(F.lit("<page>"), F.coalesce(html, F.lit(""))).alias("_html"))
    found = elements(page, key, "_html", ["page", "article", "main", *_LINES], silent=_AROUND, between=" ").where(~F.exists("kinds", lambda k: k.isin(*_AROUND)))
    size = F.length(F.regexp_replace("text", " ", ""))
    rank = F.when(F.col("tag") == "article", 2).when(F.col("tag") == "main", 1).when(F.col("tag") == "page", 0)
    best = F.struct(rank.alias("r"), F.when(F.col("tag") == "article", size).otherwise(0).alias("n"), (-F.col("pos")).alias("p"))
    main = found.where(rank.isNotNull()).groupBy(key).agg(F.max_by(F.struct(F.col("pos").alias("at"), F.col("text").alias("all")), best).alias("_m")).select(key, "_m.*")
    lines = found.where(F.col("tag").isin(*_LINES) & (F.col("text") != "")).select(key, "pos", "text", "within").join(main.select(key, "at"), key).where(F.array_contains("within", F.col("at")))
    joined = lines.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]), "\n").alias("_t"))
    return main.join(joined, key, "left").select(key, F.left(F.coalesce("_t", "all"), F.lit(most)).alias("text"))
