"""Table schemas. Listing values stay text: nothing downstream computes with them."""

from __future__ import annotations

from pyspark.sql import types as T

LISTING_FIELDS = (
    "ip", "port", "address", "anonymous", "http",
    "speed", "resptime", "alivetime", "testtime", "portimage",
)


def _texts(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


LISTING_ROW = T.StructType(_texts(*LISTING_FIELDS))

PAGES = T.StructType([
    *_texts("site", "kind", "kinddesc", "domain", "url"),
    # Arrival number, one page each; a page without one or that shares one fails.
    T.StructField("page_seq", T.LongType()),
    T.StructField("status", T.IntegerType()),  # of the response; recorded, never tested
    *_texts("html"),
])

ITEM = T.StructType([
    *_texts("url", "domain", "kinddesc"),
    T.StructField("page_seq", T.LongType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("n_chars", T.IntegerType()),
    T.StructField("reslist", T.ArrayType(LISTING_ROW)),
    *_texts("error", "trace"),
])

POOL = T.StructType([
    *_texts("_id"),
    *LISTING_ROW.fields,
    *_texts("domain", "kinddesc"),
    T.StructField("status", T.IntegerType()),
    T.StructField("timestamp", T.TimestampType()),
    *_texts("rmrk"),
])

CRAWDETAIL = T.StructType([
    *_texts("url", "kinddesc"),
    *[T.StructField(n, T.LongType()) for n in ("total", "addcount", "existcount")],
    *_texts("timestamp"),
])

CRAWLOG = T.StructType(_texts("url", "status", "kinddesc", "records", "timestamp"))

RECORD = T.StructType([
    *_texts("_id", "ip", "port", "anonymous"),
    T.StructField("status", T.IntegerType()),
    *_texts("http", "kinddesc"),
])

OUTCOME = T.StructType([
    T.StructField("result", T.IntegerType()),
    *_texts("purl"),
    T.StructField("record", RECORD),
    T.StructField("order_ts", T.TimestampType()),
    T.StructField("seq", T.LongType()),
])

NOW = T.StructType([
    *_texts("url"),
    T.StructField("tm", T.TimestampType()),
    *_texts("anonymous"),
])

HISTORY = RECORD
