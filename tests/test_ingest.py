import random

import pytest

import models
from rollbook.operators import ingest

SIGHTING = "page_seq long, row_no int, ip string, port string"


def frames(spark, pages, pool):
    rows = [(page, i, *key) for page, keys in pages for i, key in enumerate(keys)]
    found = spark.createDataFrame(rows, SIGHTING)
    listed = spark.createDataFrame([(page, f"u{page}") for page, _ in pages], "page_seq long, url string")
    return found, spark.createDataFrame(pool, "ip string, port string"), listed


def random_case(seed):
    rng = random.Random(seed)
    keys = [(rng.choice(["a", "b", "c", None]), rng.choice(["1", "2", "3", None])) for _ in range(9)]
    pages = [(n * 7, rng.choices(keys, k=rng.randrange(6))) for n in range(rng.randrange(1, 12))]
    return pages, rng.sample(keys, rng.randrange(3))


@pytest.mark.parametrize("seed", range(12))
def test_equals_row_by_row_ingest(spark, seed):
    pages, pool = random_case(seed)
    found, pooled, listed = frames(spark, pages, pool)
    admitted, counts = models.ingest(pages, pool)
    got = [(r.page_seq, r.row_no) for r in ingest.admit(found, pooled).collect()]
    assert sorted(got) == sorted(admitted)
    flagged = ingest.flag_new(found, pooled).collect()
    assert len(flagged) == found.count()
    assert sorted((r.page_seq, r.row_no) for r in flagged if r.is_new) == sorted(admitted)
    assert ingest.existing(found, pooled).count() == found.count() - len(admitted)
    account = ingest.accounting(found, pooled, listed).collect()
    assert {r.page_seq: (r.total, r.addcount, r.existcount) for r in account} == counts
    seen = spark.createDataFrame([(p, len(k)) for p, k in pages], "page_seq long, seen long")
    after = ingest.accounting_after(seen, ingest.admit(found, pooled)).collect()
    assert {r.page_seq: (r.total, r.addcount, r.existcount) for r in after} == counts


def test_same_page_duplicates_stay_and_later_pages_add_nothing(spark):
    key = ("192.0.2.1", "80")
    found, pooled, listed = frames(spark, [(1, [key, key]), (2, [key]), (3, [])], [])
    assert ingest.admit(found, pooled).count() == 2
    account = ingest.accounting(found, pooled, listed).orderBy("page_seq").collect()
    assert [(r.total, r.addcount, r.existcount) for r in account] == [(2, 2, 0), (0, 0, 1), (0, 0, 0)]


def test_missing_equals_missing(spark):
    found, pooled, _ = frames(spark, [(1, [(None, "80"), ("x", None)])], [(None, "80")])
    assert [r.ip for r in ingest.admit(found, pooled).collect()] == ["x"]


def test_hot_key_is_reduced_before_the_shuffle_and_joined_by_page(spark):
    rows = [(i // 100, i % 100, "hot" if i % 3 == 0 else f"k{i % 997}", "80") for i in range(30_000)]
    found = spark.createDataFrame(rows, SIGHTING)
    pooled = spark.createDataFrame([], "ip string, port string")
    pages = {}
    for page, _, ip, port in rows:
        pages.setdefault(page, []).append((ip, port))
    admitted, _ = models.ingest(sorted(pages.items()), [])
    out = ingest.admit(found, pooled)
    assert out.count() == len(admitted)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "collect_list" not in plan
    assert "partial_min" in plan


def test_pool_rows(spark):
    from pyspark.sql import functions as F

    found, pooled, _ = frames(spark, [(1, [("a", "1")])], [])
    row = ingest.pool_rows(found, F.lit("id"), F.lit("2024-01-01").cast("timestamp")).first()
    assert (row._id, row.status, row.rmrk, row.timestamp.year) == ("id", 0, "", 2024)


def test_sightings_without_a_page_share_the_last_one(spark):
    found = spark.createDataFrame([("a", "1", None), ("a", "1", 5), ("b", "1", None), ("b", "1", None)], "ip string, port string, page_seq long")
    pool = spark.createDataFrame([], "ip string, port string")
    entered = sorted((r.ip, r.page_seq) for r in ingest.admit(found, pool).collect())
    assert entered == [("a", 5), ("b", None), ("b", None)]
    assert [(r.ip, r.page_seq) for r in ingest.existing(found, pool).collect()] == [("a", None)]
    pages = spark.createDataFrame([(None,), (5,)], "page_seq long")
    counts = {r.page_seq: (r.addcount, r.existcount) for r in ingest.accounting(found, pool, pages).collect()}
    assert counts == {5: (1, 0), None: (2, 1)}
