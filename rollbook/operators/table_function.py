"""Listing layouts as a table function for SQL.

    register_listing_rows(spark, {"mine": Layout(...)})
    SELECT p.url, r.* FROM pages p, LATERAL listing_rows(p.html, p.site) r

Layouts are looked up by name, the package's own and the caller's. A page gives its rows, or one
row with its error and none of its rows (E7). The function sees one page at a time, so a site with
a third of all pages is spread like any other.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import rollbook
from pyspark import cloudpickle
from pyspark.sql import SparkSession, functions as F

from rollbook.operators.markup import PageError, read_listing
from rollbook.sources.sites import SITES, Layout

# What runs in tasks travels with its code: executors need not have the package.
cloudpickle.register_pickle_by_value(rollbook)

ROW = "row_no int, cells array<string>, error string"


def listing_rows(layouts: Mapping[str, Layout]):
    known = {**{s.name: s.layout for s in SITES}, **layouts}

    class ListingRows:
        def eval(self, html: str, site: str) -> Iterator[tuple]:
            try:
                rows = read_listing(html, known.get(site))
            except PageError as problem:
                yield None, None, str(problem)
            except Exception as problem:  # whatever a page does to the parser is its own failure
                yield None, None, f"{type(problem).__name__}: {problem}"
            else:
                for number, cells in enumerate(rows):
                    yield number, cells, None

    return F.udtf(ListingRows, returnType=ROW, useArrow=True)


def register_listing_rows(spark: SparkSession, layouts: Mapping[str, Layout], name: str = "listing_rows") -> None:
    """Makes the layouts known to SQL under ``name``; a layout of a site's name replaces its own."""
    spark.udtf.register(name, listing_rows(layouts))
