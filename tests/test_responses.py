"""Pages as bytes: charsets, files, streams."""

import pytest
from pyspark.sql import functions as F

from listings import narrow_page, narrow_row, page, wide_page, wide_row
from rollbook.operators import extract as ex
from rollbook.schemas import PAGES
from rollbook.session import fresh_dir
from rollbook.sources.responses import Undecodable, decoded, page_files
from rollbook.streaming.harvest import harvest_stream
from rollbook.streaming.ledger import Ledger

TEXT = "<html>高匿 é</html>"
META = "<html><meta http-equiv=Content-Type content='text/html; charset={}'>高匿</html>"


@pytest.mark.parametrize(
    "body, content_type, want",
    [
        (TEXT.encode(), None, TEXT),
        (TEXT.encode("utf-8-sig"), "text/html; charset=gbk", TEXT),
        (TEXT.encode("utf-16"), None, TEXT),
        (TEXT.encode("utf-32"), None, TEXT),
        ("高匿€㐀".encode("gb18030"), "text/html;charset='GB2312'", "高匿€㐀"),
        (META.format("gbk").encode("gbk"), None, META.format("gbk")),
        (META.format("gbk").encode(), "text/html; charset=utf-8", META.format("gbk")),
        ("é".encode("latin-1"), "text/html; charset=ISO-8859-1", "é"),
        (b"", None, ""),
    ],
)
def test_charsets(body, content_type, want):
    assert decoded(body, content_type) == want


@pytest.mark.parametrize("body, content_type", [(TEXT.encode("gbk"), None), (TEXT.encode(), "x; charset=klingon"), (TEXT.encode(), "x; charset=hex"), (b"\xff\xfe\x00", None)])
def test_bytes_that_are_no_text_fail(body, content_type):
    with pytest.raises(Undecodable):
        decoded(body, content_type)


def pages():
    return [
        ("xici/nn/1", wide_page(wide_row("192.0.2.1", "80")), "utf-8"),
        ("cloud/3/2", narrow_page(narrow_row("192.0.2.2", "81")), "utf-16"),
        ("kuaidaili/inha/3", "<meta charset=gb2312>" + narrow_page(narrow_row("192.0.2.3", "82")), "gb18030"),
        ("xici/nn/4", wide_page(wide_row("192.0.2.4", "80")), "gbk"),  # says nothing, is no UTF-8
        ("other/x/5", wide_page(wide_row("192.0.2.5", "80")), "utf-8"),
    ]


def landed(tmp_path):
    for place, html, charset in pages():
        file = tmp_path / f"{place}.html"
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(html.encode(charset))
    (tmp_path / "xici" / "readme.txt").write_text("no page")
    return str(tmp_path)


def test_files_give_the_rows_of_their_texts(spark, tmp_path):
    items = ex.extract(page_files(spark, landed(tmp_path))).cache()
    got = {r.page_seq: r for r in items.collect()}
    texts = [page(p.split("/")[0], int(p.split("/")[2]), html, kind=p.split("/")[1]) for p, html, _ in pages()]
    want = {r.page_seq: r for r in ex.extract(spark.createDataFrame(texts, PAGES)).collect()}
    assert set(got) == set(want)
    for n in (1, 2, 3):
        assert got[n].reslist == want[n].reslist and got[n].n_chars == want[n].n_chars and got[n].error is None
    assert got[1].url == "http://www.xicidaili.com/nn/1" and got[1].kinddesc == "国内高匿" and got[2].domain == "www.ip3366.net"
    assert got[4].error.startswith("no utf-8 text") and got[4].n_chars is None and "in decoded" in got[4].trace
    assert got[5].error == "no layout for this site" and got[5].url.endswith("other/x/5.html")
    log = ex.error_log(items, F.lit("2024-01-02").cast("timestamp")).collect()
    assert len(log) == 2 and all(r.records.startswith(ex.ERROR_PREFIX + "Traceback") for r in log)


def test_a_stream_of_files(spark, tmp_path):
    root = fresh_dir(spark, "raw")
    harvest_stream(spark, landed(tmp_path), root, as_of=F.lit("2024-01-02").cast("timestamp"), pause=None, raw=True).awaitTermination()
    ledger = Ledger(spark, root)
    assert sorted(r.ip for r in ledger.pool().collect()) == ["192.0.2.1", "192.0.2.2", "192.0.2.3"]
    assert ledger.crawlog().count() == 2 and ledger.rounds().first().failures == 2
