import duckdb
import pytest

import __spark_entry__ as entry
from rollbook.plans.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    result = duck.execute(entry.oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    want = sorted(repr([row[names.index(c)] for c in columns]) for row in result.fetchall())
    got = sorted(repr([row[c] for c in columns]) for row in df.collect())
    assert got == want
    assert got
