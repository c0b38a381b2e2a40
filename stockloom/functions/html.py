"""Table rows and marked elements of HTML pages, as arrays.

Only the tag reading runs in Python, batch by batch over Arrow. It returns plain
arrays; choosing, matching and reshaping them is left to Spark expressions. Pages that
cannot match are cut to null before they reach Python.
"""

from __future__ import annotations

from functools import reduce
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T



def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


_TEXT, _INT = T.StringType(), T.IntegerType()
CELL = _struct(text=_TEXT, bare=_TEXT, href=_TEXT)
ROW = _struct(sections=T.ArrayType(_TEXT), table_no=_INT, table_class=_TEXT, cells=T.ArrayType(CELL))
BLOCK = _struct(tag=_TEXT, css=_TEXT, bare=_TEXT, bold=_TEXT)

_text, _int = pa.string(), pa.int32()
_CELL = pa.struct({"text": _text, "bare": _text, "href": _text})
_ROW = pa.struct(
    {
        "sections": pa.list_(_text),
        "table_no": _int,
        "table_class": _text,
        "cells": pa.list_(_CELL),
    }
)
_BLOCK = pa.struct({"tag": _text, "css": _text, "bare": _text, "bold": _text})

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_SILENT = frozenset(("script", "style"))


class _Element:
    __slots__ = ("tag", "css", "pieces", "href", "bold", "in_bold")

    def __init__(self, tag: str, css: str):
        self.tag, self.css = tag, css
        self.pieces: list[str] = []
        self.href: str | None = None
        self.bold: list[str] | None = None
        self.in_bold = False

    def text(self) -> str:
        return "".join(self.pieces).strip()

    def bare(self) -> str:
        return "".join(p.strip() for p in self.pieces)


class _Reader(HTMLParser):
    """Feeds text, links and bold parts to every element that is currently open."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[_Element] = []
        self.muted = 0
        self.in_text = False  # the last thing read was text, so more text continues it

    def begin(self, tag: str, attrs: dict) -> None: ...

    def finish(self, tag: str) -> None: ...

    def handle_starttag(self, tag, attrs):
        self.in_text = False
        attrs = dict(attrs)
        self.muted += tag in _SILENT
        if tag == "a":
            for element in self.open:
                if element.href is None:
                    element.href = attrs.get("href")
        elif tag == "b":
            for element in self.open:
                if element.bold is None:
                    element.bold, element.in_bold = [], True
        self.begin(tag, attrs)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.in_text = False
        if tag in _SILENT:
            self.muted = max(0, self.muted - 1)
        if tag == "b":
            for element in self.open:
                element.in_bold = False
        self.finish(tag)

    def handle_data(self, data):
        if self.muted:
            return
        for element in self.open:
            _extend(element.pieces, data, self.in_text)
            if element.in_bold:
                _extend(element.bold, data, self.in_text)
        self.in_text = True

    def handle_comment(self, data):
        self.in_text = False

    def parse_marked_section(self, i, report=1):
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:  # unknown section keyword: skip it like a comment
            return self.parse_bogus_comment(i)


def _extend(pieces: list[str], data: str, same_piece: bool) -> None:
    if same_piece and pieces:
        pieces[-1] += data
    else:
        pieces.append(data)


class _Table:
    """A table that is being read: its open row and cell."""

    __slots__ = ("number", "css", "row", "cell")

    def __init__(self, number: int, css: str):
        self.number, self.css = number, css
        self.row: dict | None = None
        self.cell: _Element | None = None


class _Rows(_Reader):
    """Rows of data cells; an unclosed cell or row ends where the next one of its table starts.

    A table inside a cell has rows of its own; its text belongs to the outer cell, too,
    which goes on behind it.
    """

    def __init__(self):
        super().__init__()
        self.rows: list[dict] = []
        self.tables = 0
        self.nest: list[_Table] = []
        self.divs: list[str | None] = []

    def begin(self, tag, attrs):
        if tag == "div":
            self.divs.append(attrs.get("id"))
        elif tag == "table":
            self.nest.append(_Table(self.tables, attrs.get("class") or ""))
            self.tables += 1
        elif tag == "tr" and self.nest:
            self.close_cell()
            table = self.nest[-1]
            table.row = {
                "sections": [d for d in self.divs if d],
                "table_no": table.number,
                "table_class": table.css,
                "cells": [],
            }
            self.rows.append(table.row)
        elif tag in ("td", "th"):
            self.close_cell()
            if tag == "td" and self.nest and self.nest[-1].row is not None:
                cell = _Element(tag, attrs.get("class") or "")
                self.nest[-1].cell = cell
                self.open.append(cell)
                self.nest[-1].row["cells"].append(cell)

    def close_cell(self):
        if self.nest and self.nest[-1].cell is not None:
            self.open.remove(self.nest[-1].cell)
            self.nest[-1].cell = None

    def finish(self, tag):
        if tag in ("td", "th", "tr", "table"):
            self.close_cell()
        if tag == "table" and self.nest:
            self.nest.pop()
        elif tag == "div" and self.divs:
            self.divs.pop()

    def result(self):
        for row in self.rows:
            row["cells"] = [
                {"text": c.text(), "bare": c.bare(), "href": c.href} for c in row["cells"]
            ]
        return self.rows


class _Blocks(_Reader):
    """Elements of the wanted tags or classes, nested ones included."""

    def __init__(self, tags: frozenset, classes: frozenset):
        super().__init__()
        self.tags, self.classes = tags, classes
        self.found: list[_Element] = []
        self.depth: list[tuple[str, _Element | None]] = []

    def begin(self, tag, attrs):
        if tag in _VOID:
            return
        css = attrs.get("class") or ""
        element = None
        if tag in self.tags or not self.classes.isdisjoint(css.split()):
            element = _Element(tag, css)
            self.found.append(element)
            self.open.append(element)
        self.depth.append((tag, element))

    def finish(self, tag):
        # Close up to the matching start tag; stray end tags are ignored.
        level = next((i for i in range(len(self.depth) - 1, -1, -1) if self.depth[i][0] == tag), None)
        if level is None:
            return
        for _, element in self.depth[level:]:
            if element is not None:
                self.open.remove(element)
        del self.depth[level:]

    def result(self):
        return [
            {
                "tag": e.tag,
                "css": e.css,
                "bare": e.bare(),
                "bold": None if e.bold is None else "".join(p.strip() for p in e.bold),
            }
            for e in self.found
        ]


def _read(reader: _Reader, page: str):
    reader.feed(page)
    reader.close()
    return reader.result()


@F.arrow_udf(T.ArrayType(ROW))
def _rows(pages: pa.Array) -> pa.Array:
    rows = (None if p is None else _read(_Rows(), p) for p in pages.to_pylist())
    return pa.array(rows, pa.list_(_ROW))


def table_rows(html: Column, *marks: str) -> Column:
    """All rows of all tables in page order; null where the page has no table.

    With ``marks``, pages that hold none of these texts are not read either.
    """
    relevant = html.rlike(r"(?i)<table\b")
    if marks:
        relevant = relevant & reduce(Column.__or__, [html.contains(m) for m in marks])
    return _rows(F.when(relevant, html))


def headings(html: Column, *tags: str) -> Column:
    """Elements of the given tags.

    Comments, scripts and styles are blanked and the elements cut out by expressions,
    so Python sees a few short fragments instead of whole pages.
    """
    visible = F.regexp_replace(
        html, r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>", " "
    )
    names = "|".join(tags)
    fragments = F.regexp_extract_all(
        visible, F.lit(rf"(?is)<({names})\b[^>]*>.*?(?:</\1\s*>|\z)"), F.lit(0)
    )
    return _block_reader(frozenset(tags), frozenset())(F.concat_ws("\n", fragments))


def marked(html: Column, css_class: str) -> Column:
    """Elements that carry a CSS class, whatever their tag."""
    return _block_reader(frozenset(), frozenset([css_class]))(
        F.when(html.contains(css_class), html)
    )


def _block_reader(tags: frozenset, classes: frozenset):
    @F.arrow_udf(T.ArrayType(BLOCK))
    def blocks(pages: pa.Array) -> pa.Array:
        found = (None if p is None else _read(_Blocks(tags, classes), p) for p in pages.to_pylist())
        return pa.array(found, pa.list_(_BLOCK))

    return blocks


def has_class(css: Column, name: str) -> Column:
    return F.array_contains(F.split(css, r"\s+"), name)
