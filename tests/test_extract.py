import datetime as dt
from collections.abc import Iterator

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from listings import narrow_page, narrow_row, page, wide_page, wide_row
from rollbook.operators import extract as ex
from rollbook.schemas import LISTING_FIELDS, PAGES
from rollbook.session import BATCH_BYTES, BATCH_SETTING
from rollbook.sources.sites import SITES


@pytest.fixture(scope="module")
def items(spark):
    same = wide_row("192.0.2.1", "80", label="透明", http="https")
    pages = [
        page("xici", 1, wide_page(same, same), kind="wn", kinddesc="国外高匿"),
        page("cloud", 2, narrow_page(narrow_row("192.0.2.2", "81")), kind="3"),
        page("cloud", 3, narrow_page(narrow_row("192.0.2.2", "81")), kind="2"),
        page("kuaidaili", 4, narrow_page(narrow_row("192.0.2.3", "82", label="?")), kind="3"),
        page("xici", 5, wide_page()),
        page("xici", 6, wide_page(same, "<tr><td>x</td></tr>"), kinddesc="broken"),
        page("cloud", 7, "<html>blocked</html>"),
        page("unknown", 8, wide_page(same)),
    ]
    return ex.extract(spark.createDataFrame(pages, PAGES)).cache()


def by_page(df):
    return {r["page_seq"]: r for r in df.collect()}


def test_rows_or_error_never_both(items):
    got = by_page(items)
    assert {n for n, r in got.items() if r.error is None} == {1, 2, 3, 4, 5}
    assert all((r.reslist is None) == (r.error is not None) for r in got.values())
    assert got[5].reslist == []


def test_layouts_share_one_schema(items):
    got = by_page(items)
    assert got[1].reslist[0].asDict() == dict(zip(LISTING_FIELDS, (
        "192.0.2.1", "80", "某地", "T", "HTTPS", "0.3秒", "0.3秒", "41天", "24-03-05 07:10", ""
    )))
    assert got[2].reslist[0].asDict() == dict(zip(LISTING_FIELDS, (
        "192.0.2.2", "81", "某地", "WA", "HTTP", "1秒", "2024/03/05 07:10:00", "", "", ""
    )))


def test_only_one_site_marks_foreign_kinds(items):
    got = by_page(items)
    assert [got[n].reslist[0].anonymous for n in (1, 2, 3, 4)] == ["T", "WA", "A", "N"]


def test_unnest_copies_the_envelope(items):
    rows = ex.unnest(items).where("page_seq = 1").orderBy("row_no").collect()
    assert [(r.row_no, r.ip, r.kinddesc, r.domain) for r in rows] == [
        (0, "192.0.2.1", "国外高匿", "xici.example"), (1, "192.0.2.1", "国外高匿", "xici.example")
    ]
    assert ex.unnest(items).where("page_seq >= 5").count() == 0


def test_profile(items):
    got = {r.url: r.n_rows for r in ex.profile(items).collect()}
    assert got["http://xici.example/1"] == 2
    assert got["http://xici.example/5"] == 0
    assert got["http://xici.example/6"] is None


def test_error_log(items):
    log = ex.error_log(items, F.lit(dt.datetime(2024, 1, 2, 3, 4, 5))).orderBy("url").collect()
    assert [r.url[-1] for r in log] == ["7", "8", "6"]
    assert log[2].asDict() == {
        "url": "http://xici.example/6",
        "status": "error",
        "kinddesc": "broken",
        "records": ex.ERROR_PREFIX
        + "Traceback (most recent call last):\n  in read_listing\n  in value\nPageError: row 2: 1 cells, cell 1 wanted",
        "timestamp": "20240102030405",
    }


def test_pages_are_parsed_once_and_html_goes_no_further(spark, sf_dir):
    from rollbook.plans.standins import NAV_CELLS

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    parsed = ex.parse_cells(pages, {"nav": NAV_CELLS}, F.lit("nav"))
    kept = parsed.where(F.col("error").isNull()).select("page_id", F.explode("cells").alias("c"))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert "html" not in kept.columns


def test_site_config():
    assert {s.name: len(s.kinds) * (s.last_page - s.first_page + 1) for s in SITES} == {
        "xici": 12, "cloud": 24, "kuaidaili": 6
    }


def test_a_layout_of_ones_own_in_sql(spark):
    from rollbook.operators.table_function import register_listing_rows
    from rollbook.sources.sites import Cell, Layout

    mine = Layout(fields=(("name", Cell(0)), ("link", Cell(1, attr="href", child="a"))), container_id="t", row="p", cell="span", skip=0)
    register_listing_rows(spark, {"mine": mine})
    pages = [
        (1, "mine", "<div id=t><p><span>one</span><span><a href=/1>x</a></span></p><p><span>two</span><span><a href=/2>y</a></span></p></div>"),
        (2, "mine", "<div id=t><p><span>one</p></div>"), (3, "none", "<p>"), (4, "mine", None), (5, "xici", wide_page(wide_row("192.0.2.1", "80"))),
    ]
    df = spark.createDataFrame(pages, "id int, site string, html string")
    rows = spark.sql("SELECT id, r.* FROM {pages}, LATERAL listing_rows(html, site) r", pages=df).collect()
    got = {}
    for r in rows:
        got.setdefault(r.id, []).append((r.row_no, r.cells[:2] if r.cells else None, r.error))
    assert got[1] == [(0, ["one", "/1"], None), (1, ["two", "/2"], None)]
    assert got[2][0][:2] == (None, None) and got[3] == [(None, None, "no layout for this site")]
    assert got[4] == [(None, None, "no response text")] and got[5] == [(0, ["192.0.2.1", "80"], None)]


def test_a_large_batch_leaves_the_parse_in_pieces(spark):
    parse = ex._parser({s.name: s.layout for s in SITES}).func
    html = wide_page(*[wide_row("192.0.2.1", "80")] * 400)
    batch = pa.array([html, None] * 20), pa.array(["xici"] * 40), pa.nulls(40, pa.string())
    pieces = list(parse(iter([batch, tuple(column.slice(0, 0) for column in batch), batch])))
    assert max(map(len, pieces)) * len(html) / 2 <= ex.PIECE + 2 * len(html)
    parsed = [row for piece in pieces for row in piece.to_pylist()]
    assert [len(row["cells"] or ()) for row in parsed] == [400, 0] * 40
    assert [row["error"] for row in parsed] == [None, "no response text"] * 40


def test_the_parse_gets_small_batches(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    pages = spark.range(24, numPartitions=1).select(F.repeat(F.lit("x"), 1 << 20).alias("html"))
    held = spark.conf.get(BATCH_SETTING, None)
    spark.conf.unset(BATCH_SETTING)
    try:
        parsed = ex.parse_cells(pages, {}, F.lit("site"))
        assert parsed.where("error = 'no layout for this site'").count() == 24
        found = [r["n"] for r in pages.mapInArrow(sizes, "n long").collect()]
        # A batch ends with the row that fills it.
        assert sum(found) >= 24 << 20 and max(found) < BATCH_BYTES + (3 << 20)
    finally:
        spark.conf.unset(BATCH_SETTING) if held is None else spark.conf.set(BATCH_SETTING, held)


def test_undecodable_pages_reach_the_parse_in_small_batches(spark, tmp_path, monkeypatch):
    from rollbook.plans.queries import QUERIES

    parsed = ex._PARSED

    def sizes(layouts):
        # An error like a charset's, with the bytes of the batch as its name.
        def told(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            for body, _, _ in batches:
                error = f"no {body.nbytes} text"
                yield pa.array([{"n_chars": None, "cells": None, "error": error, "trace": None}] * len(body), type=parsed)

        return F.arrow_udf(told, "struct<n_chars:int,cells:array<array<string>>,error:string,trace:string>").asNondeterministic()

    monkeypatch.setattr(ex, "_parser", sizes)
    spark.range(100_000).selectExpr(
        "id AS event_id", "timestamp'2024-01-01' AS ts", "id % 1000 AS user_id", "'view' AS event_type",
        "1.5D AS value", "'{\"k\": 8}' AS props",
    ).write.parquet(f"{tmp_path}/events.parquet")
    held = spark.conf.get(BATCH_SETTING, None)
    spark.conf.unset(BATCH_SETTING)
    try:
        rows = QUERIES["raw_page_errors"](spark, str(tmp_path)).collect()
        assert len({r["url"] for r in rows}) == 1000
        # A batch ends with the page that fills it.
        found = {int(r["charset"]) for r in rows}
        assert len(found) > 4 and max(found) < BATCH_BYTES + (1 << 20)
    finally:
        spark.conf.unset(BATCH_SETTING) if held is None else spark.conf.set(BATCH_SETTING, held)
