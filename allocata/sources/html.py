"""Tables in HTML pages to rows of cells, and a holdings table to typed records.

Parsing uses the standard library's tolerant parser inside one Arrow-batched pass; everything after it is columns.
Defined results: null and empty pages and pages without such a table have no rows; rows without cells are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from allocata.functions.parsers import as_of_date, derived_multiple, dollar_amount, percentage, present, vintage_year

if TYPE_CHECKING:
    import pandas as pd


class _Tables(HTMLParser):
    """Collects tables as lists of rows of (is_header, text)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tables: list[list[list[tuple[bool, str]]]] = []
        self.open: list[list[list[tuple[bool, str]]]] = []
        self.cell: list[str] | None = None
        self.header = False

    def _close_cell(self) -> None:
        if self.cell is not None and self.open and self.open[-1]:
            self.open[-1][-1].append((self.header, " ".join("".join(self.cell).split())))
        self.cell = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "table":
            table: list = []
            self.tables.append(table)
            self.open.append(table)
        elif tag == "tr" and self.open:
            self._close_cell()
            self.open[-1].append([])
        elif tag in ("td", "th") and self.open:
            self._close_cell()
            if not self.open[-1]:
                self.open[-1].append([])
            self.cell, self.header = [], tag == "th"

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "th", "tr", "table"):
            self._close_cell()
        if tag == "table" and self.open:
            self.open.pop()

    def handle_data(self, data: str) -> None:
        if self.cell is not None:
            self.cell.append(data)


def tables(html: str | None) -> list[list[list[tuple[bool, str]]]]:
    parser = _Tables()
    parser.feed(html or "")
    parser.close()
    return [[row for row in t if row] for t in parser.tables]


def table_rows(pages: DataFrame, key: str, html: str, table_index: int = 0) -> DataFrame:
    """(key, row, cells, n_data): rows of cells of one table of each page; n_data counts cells that are no headers."""
    kind = pages.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pandas as pd

        for b in batches:
            out = []
            for k, h in zip(b[key], b[html], strict=True):
                found = tables(h)
                if table_index < len(found):
                    out += [(k, i, [t for _, t in row], sum(not th for th, _ in row)) for i, row in enumerate(found[table_index])]
            yield pd.DataFrame(out, columns=[key, "row", "cells", "n_data"])

    return pages.select(key, html).mapInPandas(run, f"`{key}` {kind}, row int, cells array<string>, n_data int")


def holdings(pages: DataFrame, key: str, html: str, header_rows: int = 2, least_cells: int = 7) -> DataFrame:
    """Typed records of a holdings table: name, vintage, committed, cash in, cash out, total value, rate (amounts in dollars)."""
    dates = pages.select(key, as_of_date(F.col(html)).alias("as_of_date"))
    rows = table_rows(pages, key, html).where((F.col("row") >= header_rows) & (F.col("n_data") >= least_cells))
    cell = [F.try_element_at("cells", F.lit(i)) for i in range(1, 8)]
    total, called, distributed = dollar_amount(cell[5]), dollar_amount(cell[3]), dollar_amount(cell[4])
    rate = F.when(~cell[6].startswith("N/M"), percentage(cell[6]))
    typed = rows.select(
        key, present(cell[0]).alias("fund_name_raw"), vintage_year(cell[1]).alias("vintage_year"), dollar_amount(cell[2]).alias("commitment_mm"), called.alias("capital_called_mm"),
        distributed.alias("capital_distributed_mm"), (total - distributed).alias("remaining_value_mm"), rate.alias("net_irr"), derived_multiple(total, called).alias("net_multiple"),
    ).where("fund_name_raw IS NOT NULL")
    return typed.join(dates, key).withColumn("extraction_method", F.lit("deterministic_html")).withColumn("extraction_confidence", F.lit(1.0))
