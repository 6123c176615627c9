"""Tables of HTML pages as rows: a table function over the standard parser, in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesieve.session import ship


class _Tables(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tables: list[list[list[str]]] = []
        self.open: list[list[list[str]]] = []
        self.cell: list[str] | None = None

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.open.append([])
            self.tables.append(self.open[-1])
        elif tag == "tr" and self.open:
            self.open[-1].append([])
        elif tag in ("td", "th") and self.open:
            self._close()
            if not self.open[-1]:
                self.open[-1].append([])
            self.cell = []

    def handle_endtag(self, tag):
        if tag in ("td", "th", "tr"):
            self._close()
        elif tag == "table" and self.open:
            self._close()
            self.open.pop()

    def handle_data(self, data):
        if self.cell is not None:
            self.cell.append(data)

    def _close(self):
        if self.cell is not None and self.open and self.open[-1]:
            self.open[-1][-1].append(" ".join("".join(self.cell).split()))
        self.cell = None


def tables_of(html: str | None) -> list[list[list[str]]]:
    """Each table's rows of cell texts, empty rows left out."""
    p = _Tables()
    p.feed(html or "")
    p.close()
    return [[r for r in t if r] for t in p.tables if any(t)]


def table_rows(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """id, table, row, cells for every row of every table."""
    ship(pages.sparkSession)
    kind = pages.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(i, t, r, cells) for i, html in zip(b.column("id").to_pylist(), b.column("html").to_pylist(), strict=True) for t, table in enumerate(tables_of(html)) for r, cells in enumerate(table)]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in rows], b.column("id").type), pa.array([x[1] for x in rows], pa.int32()), pa.array([x[2] for x in rows], pa.int32()), pa.array([x[3] for x in rows], pa.list_(pa.string()))], names=["id", "tbl", "row", "cells"])

    return pages.select(F.col(id_col).alias("id"), F.col(html_col).alias("html")).mapInArrow(run, f"id {kind}, tbl int, row int, cells array<string>")
