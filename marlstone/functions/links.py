"""Links of a listing to the kind of document they lead to."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The host of rendered pages, the path of downloads, and the names of the kinds.
PAGE_HOST = "simplesyllabus.com"
DOWNLOAD = r"/download/(\d+)/"
PAGE, FILE, NONE = "view_simplesyllabus", "download_pdf", "none"


def link_kind(href: Column, host: str = PAGE_HOST) -> Column:
    href = F.coalesce(href, F.lit(""))
    return F.when(href.contains(host), PAGE).when(F.regexp_extract(href, DOWNLOAD, 1) != "", FILE).otherwise(NONE)


def link_id(href: Column, host: str = PAGE_HOST) -> Column:
    """The last path segment of a page link, the number of a download, else null."""
    href = F.coalesce(href, F.lit(""))
    last = F.element_at(F.split(F.regexp_replace(href, "/+$", ""), "/"), -1)
    number = F.regexp_extract(href, DOWNLOAD, 1)
    return F.when(href.contains(host), last).when(number != "", number)
