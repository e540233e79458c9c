"""Page responses -> listing rows, all or nothing per page."""

from __future__ import annotations

import traceback
from collections.abc import Iterator, Mapping, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

import rollbook
from rollbook.functions.scalars import classify, classify_foreign, strip_ws, ts14
from rollbook.operators.markup import PageError, read_listing
from rollbook.session import small_batches
from rollbook.sources.responses import Undecodable, decoded
from rollbook.sources.sites import SITES, Layout, Site

# The parse travels inside the UDF, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(rollbook)

# Fixed value: what an error record's text starts with.
ERROR_PREFIX = "response解析异常, "

# Characters or bytes of pages that are parsed between two pieces of output.
PIECE = 1 << 20

_PARSED = pa.struct([
    ("n_chars", pa.int32()),
    ("cells", pa.list_(pa.list_(pa.string()))),
    ("error", pa.string()),
    ("trace", pa.string()),
])


def _trace(problem: Exception) -> str:
    """The way through this package's functions to ``problem``, without files and lines, so that
    like failures have like texts."""
    frames = traceback.extract_tb(problem.__traceback__)[1:]
    own = [f"  in {f.name}\n" for f in frames if "rollbook" in Path(f.filename).parts]
    return "".join(["Traceback (most recent call last):\n", *own, f"{type(problem).__name__}: {problem}"])


def _parser(layouts: Mapping[str, Layout]):
    def one(text, name, content_type):
        n_chars = None
        try:
            if isinstance(text, bytes):
                text = decoded(text, content_type)
            n_chars = None if text is None else len(text)
            return {"n_chars": n_chars, "cells": read_listing(text, layouts.get(name)), "error": None, "trace": None}
        except (PageError, Undecodable) as problem:
            return {"n_chars": n_chars, "cells": None, "error": str(problem), "trace": _trace(problem)}
        except Exception as problem:  # whatever a page does to the parser is its own failure
            return {"n_chars": n_chars, "cells": None, "error": f"{type(problem).__name__}: {problem}", "trace": _trace(problem)}

    def parse(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        # The cells of a batch take many times its size as Python objects.
        for batch in batches:
            found, size = [], 0
            for i in range(len(batch[0])):
                page, site, content_type = (column[i].as_py() for column in batch)
                found.append(one(page, site, content_type))
                size += len(page or "")
                if size >= PIECE:
                    yield pa.array(found, type=_PARSED)
                    found, size = [], 0
            yield pa.array(found, type=_PARSED)
            del batch  # before the next one is read

    udf = F.arrow_udf(parse, "struct<n_chars:int,cells:array<array<string>>,error:string,trace:string>")
    # Keeps the optimizer from running the parse once more for each later filter.
    return udf.asNondeterministic()


def parse_cells(pages: DataFrame, layouts: Mapping[str, Layout], site: Column) -> DataFrame:
    """Adds ``cells`` (one text array per row), or ``error`` and its ``trace``, and
    ``n_chars``. Pages have their text as ``html``, or their bytes as ``body`` (and, if known, the
    ``content_type`` of the response); these are dropped.

    Pages are parsed in the scan's own splits, whatever their number. If those are too
    few for the cores (one large file of one row group), repartition ``pages`` first.
    The session is set to small Arrow batches, if it has no size of its own.
    """
    small_batches(pages.sparkSession)
    page = F.col("html" if "html" in pages.columns else "body")
    content_type = F.col("content_type") if "content_type" in pages.columns else F.lit(None).cast("string")
    parsed = pages.withColumn("parsed", _parser(layouts)(page, site, content_type))
    return parsed.withColumns({
        name: F.col(f"parsed.{name}") for name in ("n_chars", "cells", "error", "trace")
    }).drop("html", "body", "content_type", "parsed")


def _site_rows(site: Site) -> Column:
    """E6 and the scalar rules: raw cells -> array of listing rows for one site."""
    at = {name: i for i, (name, _) in enumerate(site.layout.fields)}

    def raw(cells, name):
        return cells[at[name]] if name in at else F.lit("")

    def row(cells):
        label = raw(cells, "label")
        kind_class = classify_foreign(label, F.col("kind")) if site.foreign_prefix else classify(label)
        return F.struct(
            raw(cells, "ip").alias("ip"),
            raw(cells, "port").alias("port"),
            strip_ws(raw(cells, "address")).alias("address"),
            kind_class.alias("anonymous"),
            F.upper(raw(cells, "http")).alias("http"),
            *[raw(cells, n).alias(n) for n in ("speed", "resptime", "alivetime", "testtime")],
            F.lit("").alias("portimage"),
        )

    return F.transform("cells", row)


def extract(pages: DataFrame, sites: Sequence[Site] = SITES, partitions: int | None = None) -> DataFrame:
    """Pages of any of ``sites`` -> the page envelope, one row per page.

    In: url, domain, kind, kinddesc, site, page_seq, status, and html or body. Out: ``reslist`` (array
    of listing rows) or ``error`` (with its ``trace``), never both. The envelope is nested where the
    page is parsed, so no shuffle gathers a page's rows.

    ``partitions`` deals the pages out before they are parsed. Parsing costs far more than
    a page's bytes tell, so where pages come out of a shuffle, which is cut by bytes, or
    from few files, give the number of cores or a multiple.
    """
    if partitions:
        pages = pages.repartition(partitions)
    parsed = parse_cells(pages, {s.name: s.layout for s in sites}, F.col("site"))
    reslist = F.when(F.lit(False), F.lit(None))
    for site in sites:
        reslist = reslist.when(F.col("site") == site.name, _site_rows(site))
    return parsed.select(
        "url", "domain", "kinddesc", "page_seq", "status", "n_chars", reslist.alias("reslist"), "error", "trace"
    )


def split(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Whole pages and failed pages."""
    failed = F.col("error").isNotNull()
    return items.where(~failed), items.where(failed)


def unnest(items: DataFrame) -> DataFrame:
    """One row per listing row, envelope columns copied, ``row_no`` from 0."""
    return items.where(F.col("error").isNull()).select(
        "url", "domain", "kinddesc", "page_seq", F.posexplode("reslist").alias("row_no", "r")
    ).select("url", "domain", "kinddesc", "page_seq", "row_no", "r.*")


def profile(items: DataFrame) -> DataFrame:
    """Status, text length and parsed rows of every page (null rows: page failed)."""
    n_rows = F.when(F.col("reslist").isNotNull(), F.size("reslist"))
    return items.select("url", "status", "n_chars", n_rows.alias("n_rows"))


def error_log(items: DataFrame, as_of: Column) -> DataFrame:
    """One record per failed page, with the way to the failure where there is one."""
    return items.where(F.col("error").isNotNull()).select(
        "url",
        F.lit("error").alias("status"),
        "kinddesc",
        F.concat(F.lit(ERROR_PREFIX), F.coalesce("trace", "error")).alias("records"),
        ts14(as_of).alias("timestamp"),
    )
