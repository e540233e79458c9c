import pytest

from rollbook.sources import frontier
from rollbook.sources.frontier import seed_frontier, site_table, with_kinddesc
from rollbook.sources.sites import SITES


def test_frontier_of_the_three_sites(spark):
    rows = seed_frontier(site_table(spark)).collect()
    assert len(rows) == 42
    urls = {r.url for r in rows}
    assert len(urls) == 42
    assert {
        "http://www.xicidaili.com/wt/3",
        "http://www.ip3366.net/free/?stype=4&page=6",
        "https://www.kuaidaili.com/free/intr/1",
    } <= urls
    assert {r.kinddesc for r in rows if r.kind == "inha"} == {"国内高匿"}


def test_frontier_is_kind_major(spark):
    rows = [r for r in seed_frontier(site_table(spark)).collect() if r.site == "xici"]
    assert [(r.kind, r.page) for r in rows] == [(k, p) for k, _ in SITES[0].kinds for p in (1, 2, 3)]


def test_unknown_kind_has_no_description(spark):
    df = spark.createDataFrame([("1",), ("9",), (None,)], "kind string")
    assert [r.kinddesc for r in with_kinddesc(df, SITES[1].kinds).collect()] == ["国内高匿", None, None]


def test_the_source_equals_the_frontier(spark):
    frontier.register(spark)
    read = spark.read.format("frontier").load()
    want = frontier.seed_frontier(frontier.site_table(spark)).select(*read.columns)
    assert sorted(read.collect()) == sorted(want.collect())
    assert read.rdd.getNumPartitions() == len(SITES)


@pytest.mark.parametrize(
    "where",
    ["page = 1", "kind IN ('nn', '3')", "site = 'cloud' AND page >= 5", "page < 2 AND kind_no > 1", "url LIKE 'https%'", "page + kind_no = 3", "site = 'none'"],
)
def test_filters_are_the_sources_own(spark, where):
    frontier.register(spark)
    read = spark.read.format("frontier").load().where(where)
    want = frontier.seed_frontier(frontier.site_table(spark)).where(where).select(*read.columns)
    assert sorted(read.collect()) == sorted(want.collect())
    text = read._jdf.queryExecution().executedPlan().toString()
    left_to_spark = any(" Filter " in line for line in text.splitlines())
    assert left_to_spark == ("+" in where)
    if "site = 'cloud'" in where:
        assert read.rdd.getNumPartitions() == 1
