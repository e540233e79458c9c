import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rollbook.operators import serve
from rollbook.schemas import NOW

T0 = dt.datetime(2024, 1, 1)


def live(spark, n, anonymous="A"):
    return spark.createDataFrame(
        [(f"http://192.0.2.{i}:80", T0 + dt.timedelta(minutes=i), anonymous) for i in range(n)], NOW
    )


def draws(spark):
    return spark.range(101).withColumnRenamed("id", "request")


def test_freshest_is_a_top_k(spark):
    df = live(spark, 50).unionByName(live(spark, 5, "WA"))
    top = serve.freshest(df, 3)
    assert [r.url[-5:-3] for r in top.collect()] == ["49", "48", "47"]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_every_draw_gets_the_endpoint_at_its_remainder(spark):
    now = live(spark, 40)
    order = [r.url for r in serve.freshest(now, 30).collect()]
    got = serve.assign(draws(spark), now, F.col("request")).collect()
    assert all(r.url == order[r.draw % 30] for r in got)
    shares = Counter(Counter(r.url for r in got).values())
    assert shares == {4: 11, 3: 19}


@pytest.mark.parametrize("size", [1, 7, 29])
def test_short_lists_divide_by_their_size(spark, size):
    got = serve.assign(draws(spark), live(spark, size), F.col("request")).collect()
    assert len(got) == 101
    assert len({r.url for r in got}) == size


def test_fixed_divisor_leaves_requests_without_an_endpoint(spark):
    got = serve.assign(draws(spark), live(spark, 20), F.col("request"), modulus=30).collect()
    assert len(got) == 101
    assert all((r.url is None) == (r.draw % 30 >= 20) for r in got)


def test_empty_list_assigns_none(spark):
    got = serve.assign(draws(spark), live(spark, 0), F.col("request")).collect()
    assert len(got) == 101 and all(r.url is None for r in got)


def test_random_draws_are_drawn_once_per_request(spark):
    got = serve.assign(spark.range(2000), live(spark, 30), serve.random_draw(7)).cache()
    draws_seen = {r.draw for r in got.select("draw").collect()}
    assert draws_seen == set(range(101))
    assert got.where(F.col("url").isNull()).count() == 0
    assert got.count() == 2000


def test_find_takes_an_equality_document(spark):
    df = live(spark, 3).unionByName(live(spark, 2, "WA"))
    assert serve.find(df, {"anonymous": "WA"}).count() == 2
    assert serve.find(df, {}).count() == 5


def test_lists_longer_than_any_draw_assign_alike(spark):
    now = live(spark, 150)
    order = [r.url for r in serve.freshest(now, 150).collect()]
    for modulus in (None, 120):
        got = serve.assign(draws(spark), now, F.col("request"), n=150, modulus=modulus).collect()
        assert all(r.url == order[r.draw] for r in got)
