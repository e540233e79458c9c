"""Pages as they were delivered, as bytes, and the charset that turns them into text."""

from __future__ import annotations

import codecs
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rollbook.sources.sites import SITES, Site

FILES = "path string, modificationTime timestamp, length bigint, content binary"
#: ``<site>/<kind>/<arrival number>.html`` at the end of a path.
_PLACE = r"([^/]+)/([^/]+)/([0-9]+)\.html?$"

# Byte order marks, longest first, with their charsets.
_MARKS = (
    (codecs.BOM_UTF32_LE, "utf-32-le"),
    (codecs.BOM_UTF32_BE, "utf-32-be"),
    (codecs.BOM_UTF8, "utf-8"),
    (codecs.BOM_UTF16_LE, "utf-16-le"),
    (codecs.BOM_UTF16_BE, "utf-16-be"),
)
# Charsets that pages name when they mean the larger GB18030.
_CHINESE = frozenset({"gb2312", "gb_2312", "gb_2312-80", "gbk", "x-gbk", "cp936", "gb18030"})
_NAMED = re.compile(r"charset\s*=\s*[\"']?\s*([\w.:-]+)", re.I)
_META = re.compile(rb"<meta[^>]*?charset\s*=\s*[\"']?\s*([\w.:-]+)", re.I)
#: Bytes in which a page says its charset.
HEAD = 2048


class Undecodable(Exception):
    """Bytes that are no text in the charset they declare."""


def decoded(body: bytes, content_type: str | None) -> str:
    """The text of a response: by its byte order mark, else the charset of its header, else
    that of its markup, else UTF-8. Nothing is replaced: what does not decode fails."""
    for mark, name in _MARKS:
        if body.startswith(mark):
            body = body[len(mark) :]
            break
    else:
        header = _NAMED.search(content_type or "")
        meta = None if header else _META.search(body[:HEAD])
        name = (header[1] if header else meta[1].decode("ascii", "replace") if meta else "utf-8").lower()
        name = "gb18030" if name in _CHINESE else name
    try:
        return body.decode(name)
    except LookupError as problem:
        raise Undecodable(f"unknown charset {name}") from problem
    except UnicodeDecodeError as problem:
        raise Undecodable(f"no {name} text at byte {problem.start}") from problem


def page_files(spark: SparkSession, folder: str, sites: Sequence[Site] = SITES, stream: bool = False) -> DataFrame:
    """Files under ``folder`` as pages with ``body``, one row a file, as a table or a stream. Where
    a file lies says its site, kind and arrival number; a file of no known site and kind is a
    page without layout."""
    reader = spark.readStream if stream else spark.read
    files = reader.format("binaryFile").schema(FILES).option("recursiveFileLookup", "true").load(folder)

    def part(i: int) -> Column:
        return F.regexp_extract("path", _PLACE, i)

    known = F.create_map(*[
        column
        for s in sites
        for kind, kinddesc in s.kinds
        for column in (
            F.lit(f"{s.name}/{kind}"),
            F.struct(F.lit(s.domain).alias("domain"), F.lit(kinddesc).alias("kinddesc"), F.lit(f"{s.url_head}{kind}{s.url_tail}").alias("head")),
        )
    ])
    named = files.withColumns({"site": part(1), "kind": part(2), "number": part(3)})
    named = named.where(F.col("number") != "").withColumn("known", F.try_element_at(known, F.concat_ws("/", "site", "kind")))
    return named.select(
        "site",
        "kind",
        F.col("known.kinddesc").alias("kinddesc"),
        F.col("known.domain").alias("domain"),
        F.coalesce(F.concat("known.head", "number"), "path").alias("url"),
        F.col("number").cast("bigint").alias("page_seq"),
        F.lit(None).cast("int").alias("status"),
        F.col("content").alias("body"),
    )
