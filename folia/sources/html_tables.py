"""HTML tables as grids of cells, their header rows, and their text."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folia.functions.text import col


class _Cells(HTMLParser):
    """Cells of the first table: rows of (text, rowspan, colspan)."""

    def __init__(self) -> None:
        super().__init__()
        self.rows: list[list[list]] = []
        self.inside = False

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "tr":
            self.rows.append([])
        elif tag in ("td", "th"):
            a = dict(attrs)
            span = lambda k: int(a[k]) if str(a.get(k) or "").isdigit() and int(a[k]) > 0 else 1
            if not self.rows:
                self.rows.append([])
            self.rows[-1].append(["", span("rowspan"), span("colspan")])
            self.inside = True

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "th"):
            self.inside = False

    def handle_data(self, data: str) -> None:
        if self.inside:
            self.rows[-1][-1][0] += data


def grid(html: str | None) -> list[list[str]]:
    """Cells by row and column; a spanning cell stands in each place it covers, short rows are filled up with empty cells."""
    p = _Cells()
    p.feed(html or "")
    placed: dict[tuple[int, int], str] = {}
    for r, row in enumerate(p.rows):
        c = 0
        for text, down, across in row:
            while (r, c) in placed:
                c += 1
            for i in range(min(down, len(p.rows) - r)):
                for j in range(across):
                    placed[r + i, c + j] = " ".join(text.split())
            c += across
    width = max((c for _, c in placed), default=-1) + 1
    return [[placed.get((r, c), "") for c in range(width)] for r in range(len(p.rows))]


@F.pandas_udf(T.ArrayType(T.ArrayType(T.StringType())))
def table_grid(html: pd.Series) -> pd.Series:
    return html.map(grid)


def is_number(c: Column) -> Column:
    """A cell that is a number once currency, percent, brackets and separators are gone."""
    return F.regexp_replace(c, r"[$€£%(),\s]", "").try_cast("double").isNotNull()


def header_rows(g: Column, most: int = 3) -> Column:
    """Number of leading rows that are header: rows before the first with a number, `most` at most; one where no row or the first row has numbers."""
    numeric = F.transform(g, lambda row: F.exists(row, is_number))
    first = F.array_position(numeric, True).cast("int") - 1
    return F.when(F.size(g) <= 1, F.lit(0)).when(first <= 0, F.lit(1)).otherwise(F.least(first, F.lit(most)))


def detected_headers(g: Column, most: int = 3) -> Column:
    """Number of leading header rows of a grid, judged by each row and the next, of the first `most` rows and never of the last.

    A row is header where equal cells stand side by side, where over a third of the columns turn from text to number, or over half change between
    the two; the first row also where both rows are text and over half of the cells differ. A grid of one row is header, an empty or null one has none.
    `header_rows` is the plainer rule that `table_text` uses."""
    plain = lambda c: F.regexp_replace(c, "[%(),]", "").rlike(r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$")
    width = F.array_max(F.transform(g, F.size))
    count = lambda cells, test: F.size(F.filter(cells, test))

    def is_header(i: Column) -> Column:
        now = F.get(g, i)
        pairs = F.slice(F.arrays_zip(now.alias("a"), F.get(g, i + 1).alias("b")), 1, F.least(F.size(now), F.size(F.get(g, i + 1))))
        beside = F.arrays_zip(now.alias("a"), F.slice(now, 2, F.greatest(F.size(now) - 1, F.lit(0))).alias("b"))
        spans = F.exists(beside, lambda x: (x["a"] != "") & x["a"].eqNullSafe(x["b"]))
        turned = count(pairs, lambda x: ~plain(x["a"]) & plain(x["b"]))
        changed = count(pairs, lambda x: plain(x["a"]) != plain(x["b"]))
        worded = ~F.exists(F.concat(now, F.get(g, i + 1)), plain)
        differs = count(pairs, lambda x: x["a"] != x["b"])
        return spans | (3 * turned > width) | (2 * changed > width) | ((i == 0) & worded & (2 * differs > width))

    depth = F.least(F.lit(most), F.size(g) - 1)
    flags = F.transform(F.sequence(F.lit(0), depth - 1), is_header)
    stop = F.array_position(flags, False).cast("int")
    return F.when(F.coalesce(F.size(g), F.lit(0)) <= 0, F.lit(0)).when(F.size(g) == 1, F.lit(1)).otherwise(F.when(stop > 0, stop - 1).otherwise(depth))


def column_names(g: Column, n_header: Column) -> Column:
    """Header cells of each column from top to bottom, joined by ' > ', repeats left out."""
    width = F.size(F.get(g, F.lit(0)))
    return F.when(width <= 0, F.array().cast("array<string>")).otherwise(
        F.transform(
            F.sequence(F.lit(0), width - 1),
            lambda c: F.array_join(F.filter(F.array_distinct(F.transform(F.slice(g, 1, n_header), lambda row: F.get(row, c))), lambda x: x != ""), " > "),
        )
    )


def table_text(grid_col: Column | str, caption: Column, footnote: Column) -> Column:
    """Caption, columns, rows between bars, footnote of a grid; a line each, empty ones left out."""
    g = col(grid_col)
    n = header_rows(g)
    rows = F.transform(F.slice(g, n + 1, F.greatest(F.lit(0), F.size(g) - n)), lambda r: F.concat(F.lit("| "), F.array_join(r, " | "), F.lit(" |")))
    body = F.array_join(rows, "\n")
    some = lambda c: F.when(F.coalesce(c, F.lit("")) != "", c)
    return F.concat_ws("\n", some(caption), some(F.array_join(column_names(g, n), ", ")), some(body), some(footnote))


def merge_tables(first: Column, second: Column) -> Column:
    """Rows of the second grid under the first."""
    return F.concat(first, second)
