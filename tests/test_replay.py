import contextlib
import random

import pytest

import models
from pyspark.sql import functions as F
from rollbook.operators import replay

EVENT = "ip string, port string, seq long, dead boolean"


@pytest.fixture
def in_parts(spark):
    """So many shuffle partitions, none put together."""

    @contextlib.contextmanager
    def setting(n):
        held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
        for key, value in zip(held, (n, "false")):
            spark.conf.set(key, value)
        yield
        for key, value in held.items():
            spark.conf.set(key, value)

    return setting


def random_log(seed, size):
    rng = random.Random(seed)
    keys = [(rng.choice(["a", "b", None]), rng.choice(["1", "2", None])) for _ in range(5)]
    return [(rng.choice(keys), rng.random() < 0.3) for _ in range(size)]


def frame(spark, log, first=0):
    return spark.createDataFrame([(*k, first + i, d) for i, (k, d) in enumerate(log)], EVENT)


@pytest.mark.parametrize("parts", [1, 3, 16])
@pytest.mark.parametrize("seed", range(3))
def test_replay_equals_one_by_one(spark, in_parts, seed, parts):
    log = random_log(seed, 120)
    admitted, members = models.replay(log)
    with in_parts(parts):
        got = replay.admissions(frame(spark, log)).collect()
    assert sorted(r.seq for r in got) == admitted
    assert {(r.ip, r.port) for r in replay.members(frame(spark, log)).collect()} == members


@pytest.mark.parametrize("seed", range(3))
def test_state_carries_on(spark, in_parts, seed):
    log = random_log(seed, 100)
    admitted, _ = models.replay(log)
    head, tail = frame(spark, log[:37]), frame(spark, log[37:], 37)
    state = replay.last_events(head).drop("seq")
    with in_parts(7):
        got = [r.seq for r in replay.admissions(head).collect()]
        got += [r.seq for r in replay.admissions(tail, state=state).collect()]
    assert sorted(got) == admitted


def test_other_columns_pass_through(spark):
    log = frame(spark, [(("a", "1"), False)]).withColumn("extra", F.lit("x"))
    assert replay.admissions(log).first().asDict() == {
        "ip": "a", "port": "1", "seq": 0, "dead": False, "extra": "x"
    }


def test_a_hot_key_is_cut_into_even_parts(spark, in_parts):
    """Numbers are microseconds since 1970, with gaps; a third of the rows have one key."""
    rng = random.Random(8)
    log = [(("hot", "1") if i % 3 == 0 else (f"k{i % 700}", "1"), rng.random() < 0.3) for i in range(12_000)]
    at = [1_700_000_000_000_000 + i * i * 1_000 for i in range(len(log))]
    df = spark.createDataFrame([(*k, t, d) for (k, d), t in zip(log, at)], EVENT)
    admitted, _ = models.replay(log)
    with in_parts(12):
        out = replay.admissions(df).collect()
        dealt = df.repartitionByRange("ip", "port", "seq").groupBy(F.spark_partition_id().alias("p"))
        sizes = sorted(r["n"] for r in dealt.agg(F.count("*").alias("n"), F.max("ip").alias("ip")).collect())
    assert sorted(r.seq for r in out) == [at[i] for i in admitted]
    assert len(sizes) == 12 and sizes[-1] < 3 * sizes[6]


def test_an_empty_log_admits_nothing(spark):
    assert replay.admissions(frame(spark, [])).collect() == []
