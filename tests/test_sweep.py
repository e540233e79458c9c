import random

import pytest

import models
from rollbook.operators import sweep

POOL = "_id string, anonymous string, status int"


@pytest.mark.parametrize("seed", range(6))
def test_one_projection_equals_the_level_loop(spark, seed):
    rng = random.Random(seed)
    classes = ["A", "C", "T", "N", "WA", "WC", "WN", None]
    pool = [[str(i), rng.choice(classes), rng.randrange(6)] for i in range(rng.randrange(1, 60))]
    want, dispatched = models.sweep(pool)
    df = spark.createDataFrame(pool, POOL)
    swept = sweep.sweep(df)
    assert sorted([r._id, r.anonymous or "", r.status] for r in swept.collect()) == sorted(
        [a, b or "", c] for a, b, c in want
    )
    full = swept.selectExpr("_id", "'i' ip", "'p' port", "anonymous", "status", "'H' http", "'k' kinddesc")
    got = [(r._id, r.status) for r in sweep.dispatch(full).collect()]
    assert sorted(got) == sorted(dispatched)
    assert [s for _, s in got] == sorted((s for _, s in got), reverse=True)
    levels = [r.status for r in sweep.status_levels(df).collect()]
    assert levels == sorted({s for _, a, s in pool if models.eligible(a)}, reverse=True)
    counts = {r.status: r.n for r in sweep.dispatch_count(full).collect()}
    assert counts == {s: sum(x == s for _, x in dispatched) for s in {x for _, x in dispatched}}
