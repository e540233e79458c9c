"""The given tables seen as sightings, pool, probes and listing pages.

Each stand-in covers its whole table. ``event_id`` is the arrival number of events.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from rollbook.functions.scalars import classify, endpoint_url
from rollbook.operators.outcomes import classify_probes
from rollbook.operators.sweep import DISPATCHED
from rollbook.sources.sites import SITES, Cell, Layout

# Event types in the role of class labels and of schemes.
LABELS = {"signup": "高匿", "click": "普匿名", "view": "普通代理IP", "purchase": "透明", "error": "x"}
# Customer segments in the role of the event types a seeded pool key has.
SEGMENTS = {
    "FURNITURE": "signup",
    "HOUSEHOLD": "click",
    "MACHINERY": "view",
    "AUTOMOBILE": "purchase",
    "BUILDING": "error",
}
ROWS_PER_PAGE = 100


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mapped(column: Column, names: dict[str, str]) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in names.items() for x in pair]), column)


def label_of(event_type: Column) -> Column:
    return mapped(event_type, LABELS)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def prop(props: Column) -> Column:
    """The number in the JSON text of ``props``, 0..99."""
    return F.get_json_object(props, "$.k").cast("int")


def sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events: key (user, type), page = day."""
    return events(spark, sf_dir).select(
        F.col("user_id").cast("string").alias("ip"),
        F.col("event_type").alias("port"),
        F.date_format("ts", "yyyyMMdd").cast("bigint").alias("page_seq"),
        F.concat(F.lit("day/"), F.date_format("ts", "yyyy-MM-dd")).alias("url"),
        "event_id",
        F.upper(F.when(F.col("event_type") == "click", "http").otherwise("https")).alias("http"),
        classify(label_of(F.col("event_type"))).alias("anonymous"),
    )


def day_pages(found: DataFrame) -> DataFrame:
    return found.select("page_seq", "url").distinct()


def seed_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers: one pooled key each."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("ip"),
        mapped(F.col("c_mktsegment"), SEGMENTS).alias("port"),
    )


def big_sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items: key (part, supplier), page = 50 orders."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("ip"),
        F.col("l_suppkey").alias("port"),
        F.expr("l_orderkey div 50").alias("page_seq"),
    )


def big_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("ip"), F.col("p_size").cast("bigint").alias("port")
    )


def _pool_columns() -> dict[str, Column]:
    """An event as a pool row: key (user, port from props), counter 0..4."""
    kind = F.col("event_type")
    return {
        "_id": F.col("event_id").cast("string"),
        "ip": F.col("user_id").cast("string"),
        "port": (prop(F.col("props")) + 8000).cast("string"),
        "anonymous": F.concat(
            F.when(F.col("user_id") % 2 == 1, "W").otherwise(""), classify(label_of(kind))
        ),
        "status": (F.col("event_id") % 5).cast("int"),
        "http": F.when(kind == "click", "HTTP").otherwise("HTTPS"),
        "kinddesc": F.concat(F.lit("kind "), kind),
    }


def pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(*[c.alias(n) for n, c in _pool_columns().items()])


def _probe_columns() -> dict[str, Column]:
    """An event as the answer to the probe of its pool row."""
    kind = F.col("event_type")
    return {
        "err_kind": F.when(kind == "error", "http_error").when(kind == "signup", "other"),
        "order_ts": F.col("ts").cast("timestamp"),
        "seq": F.col("event_id"),
    }


def probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers that name their pool row by id."""
    answers = {"record_id": F.col("event_id").cast("string"), **_probe_columns()}
    return events(spark, sf_dir).select(*[c.alias(n) for n, c in answers.items()])


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers that carry their pool row, as the probe returns them."""
    row = _pool_columns()
    answers = {
        "record": F.struct(*[row[n].alias(n) for n in DISPATCHED]),
        "purl": endpoint_url(row["http"], row["ip"], row["port"]),
        **_probe_columns(),
    }
    found = events(spark, sf_dir).select(*[c.alias(n) for n, c in answers.items()])
    return classify_probes(found).drop("err_kind")


def now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as the live table before the outcomes."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        endpoint_url(
            F.lit("HTTPS"), key.cast("string"), (8000 + key % 100).cast("string")
        ).alias("url"),
        F.lit("2023-12-31 00:00:00").cast("timestamp").alias("tm"),
        mapped(F.col("c_mktsegment"), {k: classify_text(v) for k, v in SEGMENTS.items()}).alias(
            "anonymous"
        ),
    )


def classify_text(event_type: str) -> str:
    return {"signup": "A", "click": "A", "view": "C", "purchase": "T", "error": "N"}[event_type]


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as records that died before the outcomes."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.cast("string").alias("_id"),
        F.concat(F.lit("old-"), key.cast("string")).alias("ip"),
        F.lit("80").alias("port"),
        F.lit("A").alias("anonymous"),
        F.lit(9).alias("status"),
        F.lit("HTTP").alias("http"),
        F.col("c_mktsegment").alias("kinddesc"),
    )


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a membership log: key = user, an error is a death."""
    return events(spark, sf_dir).select(
        F.col("user_id").cast("string").alias("ip"),
        F.col("event_id").alias("seq"),
        (F.col("event_type") == "error").alias("dead"),
        F.date_format("ts", "yyyyMMdd").cast("bigint").alias("day"),
    )


# The navigation list of the given pages in the role of a listing.
NAV_ROWS = Layout(
    container_tag="nav",
    row="li",
    cell="a",
    fields=(("text", Cell(0)), ("href", Cell(0, attr="href"))),
)
NAV_CELLS = Layout(
    container_tag="nav",
    row="ul",
    cell="li",
    skip=0,
    fields=tuple((f"c{i}", Cell(i)) for i in range(6)),
)
NAV_LINKS = Layout(
    container_tag="nav",
    row="ul",
    cell="li",
    skip=0,
    fields=tuple((f"c{i}", Cell(i, attr="href", child="a")) for i in range(4)),
)


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages")


def _td(*parts: Column | str) -> Column:
    return _join("<td>", *parts, "</td>")


def _join(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def listing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as listing rows: 100 to a page, pages in turn from the three sites."""
    k = prop(F.col("props"))
    page = F.expr(f"event_id div {ROWS_PER_PAGE}")
    site_no = page % len(SITES)
    names = F.array(*[F.lit(s.name) for s in SITES])
    domains = F.array(*[F.lit(s.domain) for s in SITES])
    kinds = F.array(*[
        F.array(*[F.struct(F.lit(a).alias("kind"), F.lit(b).alias("kinddesc")) for a, b in s.kinds])
        for s in SITES
    ])
    of_site = F.get(kinds, site_no)
    kind = F.get(of_site, F.expr(f"event_id div {ROWS_PER_PAGE * len(SITES)}") % F.size(of_site))
    return events(spark, sf_dir).select(
        "event_id",
        page.alias("page_seq"),
        F.get(names, site_no).alias("site"),
        F.get(domains, site_no).alias("domain"),
        kind["kind"].alias("kind"),
        kind["kinddesc"].alias("kinddesc"),
        _join(
            "10.0.", F.expr("user_id div 250").cast("string"), ".", (F.col("user_id") % 250).cast("string")
        ).alias("ip"),
        (8000 + k).cast("string").alias("port"),
        F.col("event_type"),
        label_of(F.col("event_type")).alias("label"),
        F.round(F.col("value") * 100).cast("bigint").cast("string").alias("amount"),
        # A broken row makes its page fail.
        ((F.col("event_type") == "error") & (k == 7)).alias("broken"),
    )


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages built from events in the sites' own layouts.

    A page gathers exactly 100 consecutive events, so its group is bounded.
    """
    rows = listing_rows(spark, sf_dir)
    http = F.when(F.col("event_type") == "click", "http").otherwise("Https")
    address = _join(
        "\n  <a href='/x'>&lt;", F.col("event_type"), "&gt; 　</a>\n"
    )

    def bar(text: Column) -> Column:
        return _join("<div title='", text, "秒' class=\"meter\"><div class=fill></div></div>")

    wide = [
        _td("<img src=x.png>"), _td(F.col("ip")), _td(F.col("port")), _td(address),
        _td(F.col("label")), _td(http),
        F.when(F.col("broken"), _td("none")).otherwise(_td(bar(F.col("amount")))),
        _td(bar(F.lit("7"))), _td("41天"), _td("24-01-01 08:15"),
    ]
    narrow = [
        _td(F.col("ip")), _td(F.col("port")), _td(F.col("label")), _td(http), _td(address),
        _td(F.col("amount"), "秒"), F.when(F.col("broken"), "").otherwise(_td("7秒")),
    ]
    is_wide = F.col("site") == SITES[0].name
    row = _join("<tr class=odd>", F.when(is_wide, F.concat(*wide)).otherwise(F.concat(*narrow)), "</tr>\n")
    body = F.array_join(
        F.transform(
            F.array_sort(F.collect_list(F.struct("event_id", row.alias("row")))), lambda r: r["row"]
        ),
        "",
    )
    head = F.when(is_wide, "<table id=ip_list><tbody>").otherwise("<div id='list'><table><tbody>")
    grouped = rows.groupBy("page_seq", "site", "domain", "kind", "kinddesc").agg(body.alias("body"))
    return grouped.select(
        "site", "kind", "kinddesc", "domain",
        _join("http://", F.col("domain"), "/", F.col("kind"), "/", F.col("page_seq").cast("string")).alias("url"),
        "page_seq",
        F.when(F.col("page_seq") % 7 == 3, 503).otherwise(200).alias("status"),
        _join(
            "<html><head><script>var t='<tr>';</script></head><body><br>", head,
            "<tr><th>head</th></tr>", F.col("body"),
            "</tbody></table><p>x</body></html>",
        ).alias("html"),
    )


def response_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listing pages as bytes, by turns in four charsets; every tenth is not what it says."""

    def encode(batches):
        for batch in batches:
            for at in range(0, len(batch), 16):  # a caller's batches may be large
                yield encoded(batch.slice(at, 16))

    def encoded(batch):
        bodies, types = [], []
        for number, html in zip(batch["page_seq"].to_pylist(), batch["html"].to_pylist()):
            name = ("utf-8", "gb18030", "gbk", "utf-16")[number % 4]
            if name == "gbk":
                html = html.replace("<head>", "<head><meta charset=GB2312>")
            bodies.append(html.encode("gb18030" if number % 10 == 9 else name))
            types.append("text/html; charset=" + ("utf-8" if number % 10 == 9 else name) if number % 2 else None)
        rest = [batch[n] for n in batch.schema.names if n != "html"]
        return pa.RecordBatch.from_arrays([*rest, pa.array(bodies, pa.binary()), pa.array(types, pa.string())], names)

    pages = listing_pages(spark, sf_dir)
    kept = [f for f in pages.schema.fields if f.name != "html"]
    names = [*(f.name for f in kept), "body", "content_type"]
    fields = [*kept, T.StructField("body", T.BinaryType()), T.StructField("content_type", T.StringType())]
    return pages.select(*(f.name for f in kept), "html").mapInArrow(encode, T.StructType(fields))
