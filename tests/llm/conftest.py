import pytest
from pyspark.sql import functions as F

#: Columns of a caller's own that share names with the operators' columns.
CLASHING = ("value", "rep", "n", "digest", "run", "host", "code", "label", "h", "parent", "gone", "sketch", "item_id")


@pytest.fixture(scope="session")
def frame(spark):
    """Rows as a table, with extra columns of clashing names."""

    def make(rows, schema):
        df = spark.createDataFrame(rows, schema)
        extra = [c for c in CLASHING if c not in df.columns]
        return df.withColumns({c: F.lit("extra") for c in extra})

    return make


@pytest.fixture(scope="session")
def documents(frame):
    def make(rows):
        return frame([(*r, *[None] * (4 - len(r))) for r in rows], "doc_id long, text string, lang string, source string")

    return make
