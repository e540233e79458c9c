from pyspark.sql import functions as F

from rollbook.functions import scalars as fx

LABELS = [
    ("高匿", "A"), ("高匿名", "A"), ("普匿", "A"), ("普通代理ip", "C"), ("透明", "T"),
    ("透明代理IP", "T"), ("透明高匿", "A"), ("透明普通", "C"), ("", "N"), ("x", "N"),
]


def test_classes(spark):
    df = spark.createDataFrame([(a, b, k) for a, b in LABELS for k in "1234"], "label string, want string, kind string")
    got = df.select(
        "want", "kind",
        fx.classify(F.col("label")).alias("plain"),
        fx.classify_foreign(F.col("label"), F.col("kind")).alias("kinded"),
    ).collect()
    for row in got:
        assert row.plain == row.want
        assert row.kinded == ("" if row.kind in "12" else "W") + row.want


def test_strip_equals_python_strip(spark):
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    texts = [f"{s}a {s} b{s}" for s in spaces] + ["".join(spaces) + "x​" + "".join(spaces), "", " \n"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(fx.strip_ws(F.col("t"))).collect()]
    assert got == [t.strip() for t in texts]


def test_endpoint_url_and_null(spark):
    df = spark.createDataFrame([("HTTPS", "192.0.2.1", "80"), ("HTTP", None, "80")], "h string, i string, p string")
    got = [r[0] for r in df.select(fx.endpoint_url(F.col("h"), F.col("i"), F.col("p"))).collect()]
    assert got == ["https://192.0.2.1:80", None]


def test_eligible_takes_a_missing_class_for_false(spark):
    df = spark.createDataFrame([(a,) for a in ["A", "WA", "WN", "W", "C", "T", "N", "AW", "", None]], "a string")
    got = {r.a: r.e for r in df.select("a", fx.eligible(F.col("a")).alias("e")).collect()}
    assert [a for a, e in got.items() if e] == ["A", "WA", "WN", "W"]
    assert got[None] is None
    assert df.where(fx.eligible(F.col("a"))).count() == 4
    assert {r.x for r in df.where("a IS NULL").select(F.when(fx.eligible(F.col("a")), 1).otherwise(0).alias("x")).collect()} == {0}


def test_outcome_has_three_cases(spark):
    df = spark.createDataFrame([(None,), ("http_error",), ("other",)], "e string")
    assert [r[0] for r in df.select(fx.outcome(F.col("e"))).collect()] == [1, 0, None]


def test_probe_route(spark):
    df = spark.createDataFrame([("A",), ("WA",), (None,)], "a string")
    got = [r[0] for r in df.select(fx.probe_route(F.col("a"))).collect()]
    assert got == [fx.DOMESTIC_TARGET, fx.FOREIGN_TARGET, fx.FOREIGN_TARGET]


def test_ts14(spark):
    got = spark.sql("select timestamp'2024-02-03 04:05:06.789' as t").select(fx.ts14(F.col("t"))).first()[0]
    assert got == "20240203040506"
