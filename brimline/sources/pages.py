"""Observation tables in HTML pages to typed records."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brimline.functions.text import NUMBER, normalize_text, tolerant_float, tolerant_int
from brimline.schema import RAW_COLUMNS

# Fixed values of the page layout.
TABLE_CLASS = "tblgridtd"
HEADER_NAMES = ["ten ho", "chu thich ky hieu"]
HEADER_TIME = "thoi diem"
MIN_CELLS = 11
GROUP_SPAN = 5

_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_HIDDEN = frozenset(["script", "style", "template"])


class _Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict):
        self.tag, self.attrs, self.children = tag, attrs, []

    def walk(self) -> Iterator[_Node]:
        """Elements below this one in document order."""
        stack = list(reversed(self.children))
        while stack:
            node = stack.pop()
            if isinstance(node, _Node):
                yield node
                stack.extend(reversed(node.children))

    def text(self) -> str:
        """Visible text, each run stripped, joined without blanks."""
        out, stack = [], list(reversed(self.children))
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                out.append(node.strip())
            elif node.tag not in _HIDDEN:
                stack.extend(reversed(node.children))
        return "".join(out)


class _Tree(HTMLParser):
    """Lenient element tree: an end tag closes up to the nearest open one of its name."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.root = _Node("", {})
        self._open = [self.root]
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        node = _Node(tag, {k: v or "" for k, v in attrs})
        self._open[-1].children.append(node)
        if tag not in _VOID:
            self._open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        for depth in range(len(self._open) - 1, 0, -1):
            if self._open[depth].tag == tag:
                del self._open[depth:]
                return

    def handle_data(self, data):
        children = self._open[-1].children
        if children and isinstance(children[-1], str):
            children[-1] += data
        else:
            children.append(data)


def table_rows(html: str) -> Iterator[dict]:
    """Rows of the observation table of one page (or of the page, when it has none)."""
    root = _Tree(html).root
    nodes = list(root.walk())
    found = (
        next((n for n in nodes if TABLE_CLASS in n.attrs.get("class", "").split()), None)
        or next((n for n in nodes if n.tag == "table"), None)
        or next((n for n in nodes if n.tag == "tbody"), None)
        or root
    )
    for number, tr in enumerate(n for n in found.walk() if n.tag == "tr"):
        cells = [n for n in tr.walk() if n.tag in ("td", "th")]
        if not cells:
            continue
        bold = next((n for n in cells[0].walk() if n.tag == "b"), None)
        spans = [c.attrs.get("colspan", "") for c in cells]
        yield {
            "row_no": number,
            "cells": [c.text() for c in cells],
            "colspans": [int(s) if s.isdecimal() else 1 for s in spans],
            "name_bold": bold.text() if bold else None,
        }


def extract_rows(pages: DataFrame, page_id: str = "page_id", html: str = "html", keep: list[str] = ()) -> DataFrame:
    """One row per table row: ``row_no``, ``cells``, ``colspans``, ``name_bold``.

    The only Python in the job; a task streams its pages batch by batch. Filtering and
    typing are left to :func:`records`.
    """
    inputs = pages.select(page_id, html, *keep)
    carried = [f"{f.name} {f.dataType.simpleString()}" for f in inputs.schema.fields if f.name != html]
    schema = ", ".join(
        [*carried, "row_no int", "cells array<string>", "colspans array<int>", "name_bold string"]
    )
    columns = [page_id, *keep, "row_no", "cells", "colspans", "name_bold"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            others = [batch[c] for c in (page_id, *keep)]
            for page, *ids in zip(batch[html], *others):
                for row in table_rows(page or ""):
                    rows.append((*ids, row["row_no"], row["cells"], row["colspans"], row["name_bold"]))
            yield pd.DataFrame(rows, columns=columns)

    return inputs.mapInPandas(run, schema)


def is_record(cells: Column, colspans: Column) -> Column:
    """Data rows: enough cells, not a group or header row, some number among the values."""
    group_row = (F.size(cells) == 1) & (F.get(colspans, F.lit(0)) >= GROUP_SPAN)
    first, second = normalize_text(F.get(cells, F.lit(0))), normalize_text(F.get(cells, F.lit(1)))
    header = first.isin(HEADER_NAMES) | (second == HEADER_TIME)
    numeric = lambda c: F.replace(c, F.lit(","), F.lit("")).rlike(rf"{NUMBER[:-1]}$|^[+-]?[nN][aA][nN]$")
    has_number = F.exists(F.slice(cells, 3, MIN_CELLS - 2), numeric)
    return ~group_row & (F.size(cells) >= MIN_CELLS) & ~header & has_number


def records(rows: DataFrame, keep: list[str] = ("page_id", "row_no")) -> DataFrame:
    """Typed raw records of the data rows. Gates that are not numbers are 0."""
    cells = F.col("cells")
    cell = lambda i: F.get(cells, F.lit(i))
    typed = [
        F.coalesce("name_bold", cell(0)).alias(RAW_COLUMNS[0]),
        cell(1).alias(RAW_COLUMNS[1]),
        *[tolerant_float(cell(i)).alias(RAW_COLUMNS[i]) for i in range(2, 9)],
        *[F.coalesce(tolerant_int(cell(i)), F.lit(0)).alias(RAW_COLUMNS[i]) for i in (9, 10)],
    ]
    return rows.filter(is_record(cells, F.col("colspans"))).select(*keep, *typed)
