"""Captured register pages -> office holders (P1), and the directors cache
(J10).

P1 is the one per-row parser of the library: HTML has to be parsed, which no
built-in Spark expression does.  Pages without a table or heading tag are
filtered out by Spark (a heading's text may be split by tags or written with
character references, so it is left to the parser); the rest run through a UDF, a page a call.
``TableRows``, a state machine over the events of Python's ``html.parser``,
keeps the open rows and cells only and never builds a page's tree.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import sinks

HOLDERS_TYPE = "array<struct<role:string,name:string,start_date:string>>"
DIRECTOR_SCHEMA = "company string, pos int, role string, name string, start_date string"


@dataclass
class _Row:
    level: int                                            # how many tables it lies in
    heading: list | None = None                           # texts of its first <h2>
    cells: list = field(default_factory=list)             # texts of each cell
    classes: set = field(default_factory=set)             # class names of its cells


class TableRows(HTMLParser):
    """``rows`` of a page's first table in the order in which they begin.

    A row or cell ends at its end tag, at the next one of the same table, or with
    the table.  Cells and headings of a table inside a cell also count for
    the row around it."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[_Row] = []
        self._level, self._over = 0, False
        self._open: list[_Row] = []
        self._texts: list[tuple[str, int, list]] = []     # (tag, level, texts) of open cells and headings

    def _end(self, tag: str) -> None:
        """Ends what is open of a tag in the current table."""
        self._texts = [t for t in self._texts if (t[0], t[1]) != (tag, self._level)]

    def _end_row(self) -> None:
        self._end("td")
        self._end("h2")
        self._open = [r for r in self._open if r.level != self._level]

    def handle_starttag(self, tag, attrs):
        if self._over or not (self._level or tag == "table"):
            return
        if tag == "table":
            self._level += 1
        elif tag == "tr":
            self._end_row()
            self._open.append(_Row(self._level))
            self.rows.append(self._open[-1])
        elif tag == "td" and self._open:
            self._end("td")
            texts = []
            self._texts.append((tag, self._level, texts))
            named = (dict(attrs).get("class") or "").split()
            for row in self._open:
                row.cells.append(texts)
                row.classes.update(named)
        elif tag == "h2" and self._open:
            texts = []
            self._texts.append((tag, self._level, texts))
            for row in self._open:
                if row.heading is None:
                    row.heading = texts

    def handle_endtag(self, tag):
        if tag == "tr":
            self._end_row()
        elif tag in ("td", "h2"):
            self._end(tag)
        elif tag == "table" and self._level:
            self._end_row()
            self._level -= 1
            self._over = not self._level

    def handle_data(self, data):
        if piece := data.strip():
            for _, _, texts in self._texts:
                texts.append(piece)


def _spaced(texts: list) -> str:
    return " ".join("".join(texts).split())


def holders(html: str | None, section: str, classes: frozenset) -> Iterator[tuple[str, str, str]]:
    """(role, name, start date) of a page's office holders.  Each heading
    switches the section on or off; only the first stretch of the section counts."""
    parser = TableRows()
    parser.feed(html or "")
    parser.close()
    on = False
    for row in parser.rows:
        if row.heading is not None:
            was, on = on, section in "".join(row.heading)
            if was and not on:
                return
            if on:
                continue  # the heading's own row names no one
        if on and len(row.cells) > 1 and row.classes & classes:
            role, name, *rest = row.cells
            yield "".join(role), _spaced(name), _spaced(rest[0]) if rest else ""


def extract_directors(pages: DataFrame, company: str = "company", html: str = "html",
                      section: str = "Functies", classes=("QL", "RL")) -> DataFrame:
    """One row per office holder: company, pos, role, name, start_date.
    Pages without a table or without the section's name give no rows."""
    marked = frozenset(classes)

    # a plain UDF: a Python worker holds the pages of one small batch (100 rows), not of an Arrow batch
    @F.udf(HOLDERS_TYPE, useArrow=False)
    def found(page):
        return [*holders(page, section, marked)]

    own = pages.select(F.col(company).cast("string").alias("company"), F.col(html).alias("html")).filter(F.lower("html").contains("<table") & F.lower("html").contains("<h2"))
    # outer: of an inner one Spark would infer a filter that parses each page once more
    rows = own.select("company", F.posexplode_outer(found("html")).alias("pos", "_holder")).filter("pos IS NOT NULL")
    return rows.select("company", "pos", "_holder.*")


def directors_cache_rows(directors: DataFrame, companies: DataFrame, as_of, company: str = "_id") -> DataFrame:
    """Cache rows for fetched companies: _id, directors (array in page
    order; empty when none were found), scraped_at."""
    grouped = (directors.groupBy("company")
               .agg(F.array_sort(F.collect_list(F.struct("pos", "role", "name", "start_date"))).alias("_d")))
    empty = F.array().cast("array<struct<role:string,name:string,start_date:string>>")
    return (companies.select(F.col(company).alias("_id")).distinct()
            .join(grouped, F.col("_id") == F.col("company"), "left")
            .select("_id", F.coalesce(F.transform("_d", lambda d: d.dropFields("pos")), empty).alias("directors"),
                    as_of.cast("timestamp").alias("scraped_at")))


def directors_to_fetch(companies: DataFrame, cache: DataFrame, key: str = "_id") -> DataFrame:
    """Companies not yet in the cache.  A cached empty list counts as
    cached."""
    return companies.join(cache.select(key).distinct(), key, "left_anti")


def update_directors_cache(cache: DataFrame, fetched: DataFrame) -> DataFrame:
    """Upsert of fetched rows into the cache (S10 form)."""
    return sinks.upsert(cache, fetched, "_id")
