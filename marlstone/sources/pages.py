"""Listing pages: option codes, table rows, truncation."""

from __future__ import annotations

from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.functions.links import link_id, link_kind

# The columns of a listing's rows, by position, and the mark of a cut listing.
COLUMNS = ("semester", "course", "unique", "title", "instructors", "cv", "syllabus", "survey")
LINK_COLUMN = COLUMNS.index("syllabus")
CUT_MARK = "Limiting results"


def option_codes(html: Column, name: str = "department") -> Column:
    """Values of the options of the named dropdown as an array; blank ones are left out, padding stays."""
    select = F.regexp_extract(html, rf'(?s)name="{name}".*?</select>', 0)
    return F.filter(F.regexp_extract_all(select, F.lit('<option value="([^"]*)"'), F.lit(1)), lambda c: F.trim(c) != "")


def is_cut(html: Column) -> Column:
    """The listing was cut at the site's cap."""
    return F.coalesce(html.contains(CUT_MARK), F.lit(False))


class _Rows(HTMLParser):
    """Cells of the body rows of table#results_table, with the first link of each cell."""

    def __init__(self) -> None:
        super().__init__()
        self.rows: list[list[tuple[str, str]]] = []
        self.depth = self.body = 0
        self.cell: list[str] | None = None
        self.href = ""

    def handle_starttag(self, tag: str, attrs: list) -> None:
        attrs = dict(attrs)
        if tag == "table" and (self.depth or attrs.get("id") == "results_table"):
            self.depth += 1
        elif self.depth and tag == "tbody":
            self.body = 1
        elif self.body and tag == "tr":
            self.rows.append([])
        elif self.body and tag == "td" and self.rows:
            self.cell, self.href = [], ""
        elif self.cell is not None and tag == "a" and not self.href:
            self.href = attrs.get("href") or ""

    def handle_endtag(self, tag: str) -> None:
        if tag == "td" and self.cell is not None:
            self.rows[-1].append(("".join(self.cell), self.href))
            self.cell = None
        elif tag == "tbody":
            self.body = 0
        elif tag == "table" and self.depth:
            self.depth -= 1

    def handle_data(self, data: str) -> None:
        if self.cell is not None:
            self.cell.append(data.strip())


@F.udtf(returnType=T.StructType([T.StructField(c, T.StringType()) for c in (*COLUMNS, "href")]))
class TableRows:
    """One row per table row with all columns; shorter ones are skipped."""

    def eval(self, html: str):
        parser = _Rows()
        parser.feed(html or "")
        for cells in parser.rows:
            if len(cells) >= len(COLUMNS):
                yield (*[t for t, _ in cells[: len(COLUMNS)]], cells[LINK_COLUMN][1])


def listing_rows(pages: DataFrame, html: str = "html", dept: str = "dept") -> DataFrame:
    """The manifest rows of listing pages (columns ``dept`` and ``html``)."""
    spark = pages.sparkSession
    spark.udtf.register("marlstone_table_rows", TableRows)
    pages.select(F.col(dept).alias("dept"), F.col(html).alias("html")).createOrReplaceTempView("marlstone_listing_pages")
    rows = spark.sql("SELECT p.dept, r.* FROM marlstone_listing_pages p, LATERAL marlstone_table_rows(p.html) r")
    return rows.withColumn("kind", link_kind(F.col("href"))).withColumn("doc_id", link_id(F.col("href")))
