"""Page structure: visible text, blocks with keywords, table cells.

Spark has no tree-building HTML function, so pages pass once through an event parser in Arrow
batches; everything after that is native.  The parser keeps one list of text pieces per page and
for every element the pieces between its tags, so its work grows with the page and not with how
deep the elements lie in each other.
"""

from bisect import bisect_left
from collections.abc import Iterator
from html.parser import HTMLParser
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridsight import fixed_values as V
from gridsight.operators.links import pdf_links

_SILENT = {"script", "style", "template"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_BLOCKS = {"p", "div", "section", "article"}
# an opening tag of the first kind ends an open tag of the second kind
_ENDS = {
    "li": ("li",), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    **{t: ("p",) for t in ("p", "div", "section", "article", "table", "ul", "ol", "h1", "h2", "h3", "h4", "h5", "h6", "nav", "header", "footer", "form", "pre")},
}
# how far up the search for such a tag may go
_WALLS = {"li": ("ul", "ol"), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table")}

# parsed pages held in a worker at a time
PAGES_AT_ONCE = 200

OUTPUTS = {
    "full_text": "string",
    "selected_text": "string",
    "sections": "array<struct<tag:string,text:string,html:string>>",
    "tables": "array<array<array<string>>>",
}


class _Element:
    """Where an element stands: its source, and its first and last piece of text."""

    __slots__ = ("tag", "start", "end", "first", "last", "silent", "rows")

    def __init__(self, tag: str, start: int, first: int, silent: bool) -> None:
        self.tag, self.start, self.end, self.first, self.last, self.silent = tag, start, start, first, first, silent
        self.rows: list = []  # of a table its rows, of a row its cells


class Page(HTMLParser):
    """The elements that are asked for, over one list of stripped text pieces."""

    def __init__(self, html: str, selector: str | None = None) -> None:
        super().__init__(convert_charrefs=True)
        self.html, self.selector = html, selector
        self.open: list[_Element] = []
        self.depths: dict[str, list[int]] = {}  # per tag, how deep its open elements lie
        self.pieces: list[str] = []
        self.blocks: list[_Element] = []
        self.tables: list[_Element] = []
        self.selected: list[_Element] = []
        starts, at = [0], html.find("\n")
        while at >= 0:
            starts.append(at + 1)
            at = html.find("\n", at + 1)
        self.line_starts = starts
        self.feed(html)
        self.close()
        self._close_down_to(0, len(html))
        self.places = list(accumulate(map(len, self.pieces), initial=0))
        self.buffer = "".join(self.pieces)

    def _offset(self) -> int:
        line, col = self.getpos()
        return self.line_starts[line - 1] + col

    def _innermost(self, tags: tuple[str, ...]) -> int:
        return max((d[-1] for t in tags if (d := self.depths.get(t))), default=-1)

    def _close_down_to(self, depth: int, end: int) -> None:
        while len(self.open) > depth:
            e = self.open.pop()
            e.end, e.last = end, len(self.pieces)
            self.depths[e.tag].pop()

    def handle_starttag(self, tag, attrs):
        here = self._offset()
        if tag in _ENDS:
            while True:
                at = self._innermost(_ENDS[tag])
                if at <= self._innermost(_WALLS.get(tag, ())):
                    break
                self._close_down_to(at, here)
                if tag != "tr":
                    break
        silent = tag in _SILENT or bool(self.open and self.open[-1].silent)
        e = _Element(tag, here, len(self.pieces), silent)
        if tag in _BLOCKS:
            self.blocks.append(e)
        elif tag == "table":
            self.tables.append(e)
        elif tag == "tr":
            for depth in self.depths.get("table", ()):
                self.open[depth].rows.append(e)
        elif tag in ("td", "th"):
            for depth in self.depths.get("tr", ()):
                self.open[depth].rows.append(e)
        if self.selector and self._selects(tag, dict(attrs)):
            self.selected.append(e)
        if tag not in _VOID:
            self.depths.setdefault(tag, []).append(len(self.open))
            self.open.append(e)

    def _selects(self, tag: str, attrs: dict) -> bool:
        s = self.selector
        if s.startswith("."):
            return s[1:] in (attrs.get("class") or "").split()
        if s.startswith("#"):
            return attrs.get("id") == s[1:]
        return tag == s.lower()

    def handle_endtag(self, tag):
        at = self._innermost((tag,))
        if at >= 0:
            here = self._offset()
            self._close_down_to(at + 1, here)
            close = self.html.find(">", here)
            self._close_down_to(at, close + 1 if close >= 0 else len(self.html))

    def handle_data(self, data):
        piece = data.strip()
        if piece and not (self.open and self.open[-1].silent):
            self.pieces.append(piece)

    def text_of(self, e: _Element) -> str:
        return self.buffer[self.places[e.first] : self.places[e.last]]

    def full_text(self) -> str:
        return " ".join(self.pieces)

    def selected_text(self) -> str:
        return " ".join(map(self.text_of, self.selected))

    def cells(self) -> list[list[list[str]]]:
        tables = [[[self.text_of(c) for c in row.rows] for row in t.rows if row.rows] for t in self.tables]
        return [t for t in tables if t]

    def sections(self, keywords: list[str]) -> list[dict]:
        """Blocks with a keyword in their text, found once in the text of the whole page."""
        low, hits = self.buffer.lower(), []
        if len(low) != len(self.buffer):  # a letter that grows in lower case moves the places behind it
            holds = [any(k in self.text_of(b).lower() for k in keywords) for b in self.blocks]
        else:
            for k in keywords:
                found, at = [], low.find(k)
                while at >= 0:
                    found.append(at)
                    at = low.find(k, at + 1)
                hits.append((found, len(k)))
            holds = [any(self._holds(b, found, n) for found, n in hits) for b in self.blocks]
        return [{"tag": b.tag, "text": self.text_of(b), "html": self.html[b.start : b.end]} for b, good in zip(self.blocks, holds) if good]

    def _holds(self, e: _Element, found: list[int], length: int) -> bool:
        i = bisect_left(found, self.places[e.first])
        return i < len(found) and found[i] + length <= self.places[e.last]


def parse_pages(
    pages: DataFrame,
    want: tuple[str, ...] = ("full_text",),
    keywords: list[str] | None = None,
    selector: str | None = None,
    key: str = "page_id",
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """``key`` and the wanted ones of full_text, selected_text, sections and tables, in one pass.

    ``selector`` is a tag name, ``.class`` or ``#id``; ``carry`` adds native columns.  Only what
    is wanted leaves the parser.
    """
    carry = carry or {}
    kept = [key, *carry]
    words = [k.lower() for k in (keywords or V.SECTION_KEYWORDS)]
    of = {"full_text": Page.full_text, "selected_text": Page.selected_text, "sections": lambda p: p.sections(words), "tables": Page.cells}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in (b.iloc[i : i + PAGES_AT_ONCE] for b in batches for i in range(0, len(b), PAGES_AT_ONCE)):
            rows = [tuple(of[w](p) for w in want) for p in (Page(h or "", selector) for h in batch["html"])]
            yield pd.DataFrame({**{c: batch[c] for c in kept}, **{w: pd.Series([r[i] for r in rows], index=batch.index, dtype=object) for i, w in enumerate(want)}})

    given = pages.select(key, "html", *[c.alias(n) for n, c in carry.items()])
    types = [f"{c} {given.schema[c].dataType.simpleString()}" for c in kept] + [f"{w} {OUTPUTS[w]}" for w in want]
    return given.mapInPandas(run, ", ".join(types))


def page_text(pages: DataFrame, key: str = "page_id") -> DataFrame:
    return parse_pages(pages, key=key)


def selected_text(pages: DataFrame, selector: str, key: str = "page_id") -> DataFrame:
    return parse_pages(pages, ("selected_text",), selector=selector, key=key)


class _Sections:
    def eval(self, html: str, keywords: list[str]) -> Iterator[tuple]:
        for i, s in enumerate(Page(html or "").sections(keywords)):
            yield i, s["tag"], s["text"], s["html"]


class _Cells:
    def eval(self, html: str) -> Iterator[tuple]:
        for i, table in enumerate(Page(html or "").cells()):
            for j, row in enumerate(table):
                for k, text in enumerate(row):
                    yield i, j, k, text


def section_function():
    """Table function (html, keywords in lower case) -> section_no, tag, text, html."""
    return F.udtf(_Sections, returnType="section_no int, tag string, text string, html string", useArrow=True).asDeterministic()


def cell_function():
    """Table function (html) -> table_no, row_no, col_no, text, numbered from 0."""
    return F.udtf(_Cells, returnType="table_no int, row_no int, col_no int, text string", useArrow=True).asDeterministic()


def register(spark: SparkSession) -> None:
    """``page_sections`` and ``page_cells`` for SQL: ``FROM pages, LATERAL page_cells(html)``."""
    spark.udtf.register("page_sections", section_function())
    spark.udtf.register("page_cells", cell_function())


def keyword_sections(pages: DataFrame, keywords: list[str] | None = None, key: str = "page_id") -> DataFrame:
    """One row per block that contains a keyword; nested blocks are all reported."""
    words = F.array(*[F.lit(k.lower()) for k in (keywords or V.SECTION_KEYWORDS)])
    given = pages.select(key, F.col("html").alias("_page"))
    found = section_function()(F.col("_page").outer(), words)
    return given.lateralJoin(found).select(key, "section_no", "tag", "text", "html")


def table_cells(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """(table, row, column, text) of every cell, numbered from 0."""
    given = pages.select(key, F.col("html").alias("_page"))
    return given.lateralJoin(cell_function()(F.col("_page").outer())).select(key, "table_no", "row_no", "col_no", "text")


def page_bundle(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """Text, keyword sections, tables and report links of every page."""
    return parse_pages(pages, ("full_text", "sections", "tables"), key=key, carry={"pdf_links": pdf_links(F.col("html"))})
