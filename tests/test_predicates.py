"""Filter documents against a row-by-row reading of their rules."""

import datetime as dt
import random
import re

import pytest

from rollbook.functions.predicates import predicate
from rollbook.functions.scalars import eligible
from rollbook.operators.ingest import ELIGIBLE

SCHEMA = "a string, n int, f double, b boolean, d date, r struct<ip:string,k:int>"
ROWS = [
    ("WA", 1, 1.5, True, dt.date(2024, 1, 1), ("x", 1)),
    ("W", 2, None, False, None, None),
    ("A", None, -2.0, None, dt.date(2023, 1, 1), (None, 5)),
    (None, 3, 0.0, True, None, ("y.z", None)),
    ("", 0, 9.0, False, dt.date(2024, 6, 1), ("wab\n", 2)),
    ("a.W", -1, 2.0, True, None, ("W^", 3)),
]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def found(table, where):
    rows = table.where(predicate(table, where)).select("a", "n").collect()
    return sorted(map(repr, ((r.a, r.n) for r in rows)))


def read(row, name):
    value = dict(zip("anfbdr", row))
    if name.startswith("r."):
        return None if value["r"] is None else dict(zip(("ip", "k"), value["r"])).get(name[2:])
    return value.get(name)


def holds(row, where):
    """The rules, one row at a time."""
    results = []
    for name, condition in where.items():
        if name == "$and":
            results.append(all(holds(row, w) for w in condition))
        elif name == "$or":
            results.append(any(holds(row, w) for w in condition))
        elif name == "$nor":
            results.append(not any(holds(row, w) for w in condition))
        else:
            results.append(fits(read(row, name), condition))
    return all(results)


def kind(value):
    return bool if isinstance(value, bool) else float if isinstance(value, (int, float)) else type(value)


def fits(value, condition):
    if isinstance(condition, re.Pattern):
        return isinstance(value, str) and bool(condition.search(value))
    if not isinstance(condition, dict):
        return value == condition and kind(value) is kind(condition)
    out = []
    for op, x in condition.items():
        alike = value is not None and kind(value) is kind(x)
        out.append({
            "$eq": lambda: fits(value, x),
            "$ne": lambda: not fits(value, x),
            "$in": lambda: any(fits(value, y) for y in x),
            "$nin": lambda: not any(fits(value, y) for y in x),
            "$gt": lambda: alike and value > x,
            "$gte": lambda: alike and value >= x,
            "$lt": lambda: alike and value < x,
            "$lte": lambda: alike and value <= x,
            "$exists": lambda: (value is not None) == x,
            "$not": lambda: not fits(value, x),
            "$regex": lambda: isinstance(value, str) and bool(re.search(x, value, re.I if "i" in condition.get("$options", "") else 0)),
            "$options": lambda: True,
        }[op]())
    return all(out)


CASES = [
    {}, {"a": "A"}, {"a": None}, {"gone": None}, {"gone": 1}, {"gone": {"$ne": 1}}, {"gone": {"$exists": False}},
    {"gone": {"$regex": "x"}}, {"gone": {"$not": {"$gt": 1}}}, {"a": {"$ne": "A"}}, {"a": {"$in": ["A", None]}},
    {"a": {"$nin": ["A", None]}}, {"a": {"$nin": ["A"]}}, {"a": {"$in": []}}, {"a": {"$nin": []}}, {"a": {"$in": [re.compile("^W"), "A"]}},
    {"n": {"$gt": 0, "$lte": 2}}, {"n": {"$not": {"$gt": 0}}}, {"n": "1"}, {"n": {"$ne": "1"}}, {"a": {"$gt": 3}}, {"b": True}, {"b": 1}, {"n": True},
    {"f": {"$lt": 1}}, {"f": 9}, {"d": {"$gte": dt.date(2024, 1, 1)}}, {"a": {"$regex": "^W"}}, {"a": {"$regex": "W"}},
    {"a": {"$regex": "^W.*"}}, {"a": {"$regex": r"a\.W"}}, {"a": {"$regex": "^w", "$options": "i"}}, {"a": re.compile("^w", re.I)},
    {"a": {"$not": {"$regex": "^W"}}}, {"a": {"$not": re.compile("W$")}}, {"a": {"$regex": "^(W|A)$"}}, {"a": {"$regex": "^"}},
    {"r.ip": "x"}, {"r.ip": None}, {"r.k": {"$gte": 2}}, {"r.gone": None}, {"a.b": None}, {"r.ip": {"$regex": r"^W\^"}}, {"r.ip": {"$regex": r"z\.*"}},
    {"$or": [{"a": "A"}, {"n": {"$gt": 1}}]}, {"$nor": [{"a": "A"}, {"n": {"$gt": 1}}]}, {"$and": [{"n": 1}, {"b": True}], "a": "WA"},
    {"$nor": [{"$and": [{"a": {"$ne": None}}, {"$or": [{"n": 1}, {"b": False}]}]}]},
]


@pytest.mark.parametrize("where", CASES, ids=map(str, range(len(CASES))))
def test_documents_follow_their_rules(table, where):
    assert found(table, where) == sorted(repr((r[0], r[1])) for r in ROWS if holds(r, where))


def test_random_documents(table):
    rng = random.Random(1)

    def document(depth):
        if depth and rng.random() < 0.6:
            return {rng.choice(["$and", "$or", "$nor"]): [document(depth - 1) for _ in range(rng.randint(1, 3))]}
        return rng.choice(CASES[1:44])

    wheres = [document(3) for _ in range(40)]
    flags = table.select("a", "n", *[predicate(table, w).alias(f"w{i}") for i, w in enumerate(wheres)]).collect()
    by = {(r.a, r.n): r for r in flags}
    for row in ROWS:
        for i, w in enumerate(wheres):
            assert bool(by[row[0], row[1]][f"w{i}"]) == holds(row, w), w


@pytest.mark.parametrize("where", [{"$or": []}, {"$xor": [{}]}, {"a": {"$near": 1}}, {"a": {"$regex": "x", "$options": "q"}}, {"$and": "x"}])
def test_what_is_no_document_is_refused(table, where):
    with pytest.raises(ValueError):
        predicate(table, where)


def test_nested_documents_reach_the_scan(spark, table, tmp_path):
    table.write.parquet(f"{tmp_path}/t")
    stored = spark.read.parquet(f"{tmp_path}/t")

    def pushed(where):
        text = stored.where(predicate(stored, where)).select("f")._jdf.queryExecution().executedPlan().toString()
        return text.split("PushedFilters: [")[1].split("]")[0]

    text = pushed({"$and": [{"n": {"$gte": 1}}, {"$or": [{"a": "A"}, {"a": {"$regex": "^W"}}]}], "b": {"$ne": True}})
    for part in ("GreaterThanOrEqual(n,1)", "Or(EqualTo(a,A),StringStartsWith(a,W))", "Not(EqualTo(b,"):
        assert part in text
    assert "Not(EqualTo(n,1))" in pushed({"$nor": [{"n": 1}, {"a": "A"}]})


def test_the_sweeps_document_is_eligibility(spark):
    df = spark.createDataFrame([(a,) for a in ["A", "WA", "W", "C", "AW", "", None]], "anonymous string")
    assert df.where(predicate(df, ELIGIBLE)).collect() == df.where(eligible(df["anonymous"])).collect()
