import datetime as dt
import random

import pytest

import models
from rollbook.operators import outcomes as oc
from rollbook.schemas import HISTORY, NOW, OUTCOME

T0 = dt.datetime(2024, 1, 1)


def outcome_rows(results):
    return [
        (r, url, (id_, ip, port, anon, status, "HTTP", "k"), tm, seq)
        for seq, (r, url, id_, ip, port, anon, status, tm) in enumerate(results)
    ]


def random_case(seed, size):
    rng = random.Random(seed)
    pool = {str(i): (f"192.0.2.{rng.randrange(8)}", str(rng.randrange(80, 83))) for i in range(25)}
    results = []
    for n in range(size):
        id_ = str(rng.randrange(25))
        ip, port = pool[id_]
        scheme = rng.choice(["http", "https"])
        results.append((
            rng.choice([0, 1, 1]), f"{scheme}://{ip}:{port}", id_, ip, port,
            rng.choice(["A", "WA"]), rng.randrange(9), T0 + dt.timedelta(seconds=n),
        ))
    now = {f"http://192.0.2.{i}:80": (T0, "A") for i in range(6)}
    history = {str(i): 99 for i in range(0, 25, 4)}
    return pool, now, history, results


def frames(spark, pool, now, history, results):
    return (
        spark.createDataFrame([(k, *v) for k, v in pool.items()], "_id string, ip string, port string"),
        spark.createDataFrame([(u, *v) for u, v in now.items()], NOW),
        spark.createDataFrame([(k, "i", "p", "A", s, "HTTP", "k") for k, s in history.items()], HISTORY),
        spark.createDataFrame(outcome_rows(results), OUTCOME),
    )


@pytest.mark.parametrize("seed, size", [(s, n) for s in range(4) for n in (0, 1, 12, 80)])
def test_fold_equals_one_by_one(spark, seed, size):
    case = random_case(seed, size)
    want_pool, want_now, want_history = models.fold(*case)
    pool, now, history = oc.fold(*frames(spark, *case))
    assert {r._id: (r.ip, r.port) for r in pool.collect()} == want_pool
    assert {r.url: (r.tm, r.anonymous) for r in now.collect()} == want_now
    assert {r._id: r.status for r in history.collect()} == want_history


def test_delete_scopes_differ(spark):
    pool = {"1": ("192.0.2.1", "80"), "2": ("192.0.2.1", "80"), "3": ("192.0.2.1", "81")}
    now = {"http://192.0.2.1:80": (T0, "A"), "https://192.0.2.1:80": (T0, "A")}
    results = [(0, "http://192.0.2.1:80", "1", "192.0.2.1", "80", "A", 1, T0)]
    pool_df, now_df, _, out = frames(spark, pool, now, {}, results)
    assert [r._id for r in oc.pool_without(pool_df, oc.dead_keys(out)).collect()] == ["3"]
    assert [r.url for r in oc.now_without(now_df, out).collect()] == ["https://192.0.2.1:80"]


def test_other_failures_change_nothing(spark):
    probes = spark.createDataFrame([("1", None), ("2", "http_error"), ("3", "boom")], "record_id string, err_kind string")
    assert {r.record_id: r.result for r in oc.classify_probes(probes).collect()} == {"1": 1, "2": 0}


def test_attached_record_is_the_dispatched_one(spark):
    sent = spark.createDataFrame(
        [("1", "192.0.2.1", "80", "A", 4, "HTTPS", "k")],
        "_id string, ip string, port string, anonymous string, status int, http string, kinddesc string",
    )
    back = spark.createDataFrame([("1", 1), ("9", 1)], "record_id string, result int")
    row = oc.attach_records(back, sent).collect()
    assert len(row) == 1
    assert row[0].purl == "https://192.0.2.1:80"
    assert row[0].record.status == 4


def test_hot_url_is_reduced_before_the_shuffle(spark):
    results = [(n % 2, "http://h:1", "1", "h", "1", "A", n, T0) for n in range(3000)]
    _, now, _, out = frames(spark, {"1": ("h", "1")}, {"http://h:1": (T0, "C")}, {"1": 1}, results)
    merged = oc.now_after(now, out)
    assert [(r.url, r.anonymous) for r in merged.collect()] == [("http://h:1", "A")]
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_outcomes_of_what_was_not_sent_are_reported(spark):
    answered = spark.createDataFrame([("1", 0), ("2", 1), (None, 1)], "record_id string, result int")
    sent = spark.createDataFrame([("1", "A")], "_id string, anonymous string")
    assert sorted(str(r.record_id) for r in oc.unmatched(answered, sent).collect()) == ["2", "None"]
