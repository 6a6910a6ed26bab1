"""Web pages: rows of an HTML table as records.

Pages stay partitioned; each task parses its own pages one at a time and yields rows, so
neither a page list nor a page's rows are gathered anywhere.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Ship the parser with the job, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CELL = "text string, link string, span string, attrs map<string, string>"


class _TableRows(HTMLParser):
    """Cells of the body rows of the first table that has a class."""

    def __init__(self, table_class: str):
        super().__init__()
        self.table_class, self.depth, self.done = table_class, 0, False
        self.body, self.body_class, self.in_body = -1, None, False
        self.rows: list[tuple[int, str | None, list[dict]]] = []
        self.cell: dict | None = None
        self.inside: dict[str, bool] = {"a": False, "span": False}

    def handle_starttag(self, tag, attrs):
        attrs = {k: v or "" for k, v in attrs}
        if tag == "table":
            if self.depth:
                self.depth += 1
            elif not self.done and self.table_class in attrs.get("class", "").split():
                self.depth = 1
        if self.depth != 1:
            return
        if tag == "tbody":
            self.in_body, self.body, self.body_class = True, self.body + 1, attrs.get("class")
        elif tag == "tr" and self.in_body:
            self.cell = None
            self.rows.append((self.body, self.body_class, []))
        elif tag == "td" and self.in_body and self.rows:
            self.cell = {"text": "", "link": None, "span": None, "attrs": attrs}
            self.rows[-1][2].append(self.cell)
        elif self.cell is not None and tag in ("a", "span"):
            field = "link" if tag == "a" else "span"
            if self.cell[field] is None:
                self.cell[field], self.inside[tag] = "", True

    def handle_data(self, data):
        if self.depth and self.cell is not None:
            self.cell["text"] += data
            for tag, field in (("a", "link"), ("span", "span")):
                if self.inside[tag]:
                    self.cell[field] += data

    def handle_endtag(self, tag):
        if tag in self.inside:
            self.inside[tag] = False
        if tag == "table" and self.depth:
            self.depth -= 1
            self.done = self.done or self.depth == 0
            self.cell = None if self.depth == 0 else self.cell
        elif self.depth == 1 and tag in ("td", "tr"):
            self.cell = None
        elif self.depth == 1 and tag == "tbody":
            self.in_body = False


def html_rows(
    pages: DataFrame, html: str, table_class: str, keep: Sequence[str] = ()
) -> DataFrame:
    """One row per body row of the page's first table with ``table_class``.

    Columns: ``keep``, ``row`` (from 0), ``body`` and ``body_class`` (which ``tbody``),
    and ``cells`` with the text, first link text, first span text and attributes of
    each ``td``. Pick what is needed with :func:`cell`.
    """
    kept = list(keep)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for page in batch.to_dict("records"):
                parser = _TableRows(table_class)
                parser.feed(page[html] or "")
                parser.close()
                if parser.rows:
                    yield pd.DataFrame(
                        [
                            {**{k: page[k] for k in kept}, "row": i, "body": b, "body_class": c, "cells": cells}
                            for i, (b, c, cells) in enumerate(parser.rows)
                        ]
                    )

    types = dict(pages.dtypes)
    schema = ", ".join(f"`{k}` {types[k]}" for k in kept)
    out = f"row int, body int, body_class string, cells array<struct<{CELL}>>"
    return pages.select(*kept, html).mapInPandas(parse, f"{schema}, {out}" if kept else out)


def cell(i: int, part: str = "text") -> Column:
    """A part of the i-th cell, trimmed; ``attr:<name>`` reads an attribute."""
    at = F.get("cells", F.lit(i))
    if part.startswith("attr:"):
        return F.trim(at.getField("attrs")[part[5:]])
    return F.trim(at.getField(part))
