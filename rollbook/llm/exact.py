"""Exact deduplication by a tree of merged digest runs, with SQL functions only.

Each row has a digest of its normalised text and belongs to one of ``RUNS`` runs. A run is
reduced to one entry per digest: its size and its best identifier. Then the runs are
exchanged in rounds of ``FAN`` (three levels of a binomial tree at once): in each round the
entries of equal digest from the runs of one parent meet and merge, until one run is left.
It is spread over all partitions by digest, so no task holds it whole. The winners go back
down the same tree, so a digest with a third of all rows is dealt by (digest, run) and
reaches its rows through many tasks.

Entries merge only if digest, length and a second, independent hash of the normalised text
agree; that verifies at each level that a digest stands for one text.

Nulls and ties: a null text is the empty one. Of equal texts the row with the most code
points stays, then the smallest id; a null id comes last. Rows with the same id are one
document and share its fate. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rollbook.llm.shared import land

RUNS, FAN = 64, 8
KEY = ["digest", "second", "chars"]

#: White space that does not count: space and the ASCII controls from tab to carriage return.
BLANKS = (" ", "\t", "\n", "\x0b", "\f", "\r")


def without_blanks(text: Column) -> Column:
    for blank in BLANKS:
        text = F.replace(text, F.lit(blank), F.lit(""))
    return text


def duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256`` (lower-case
    hex, of the normalised text in UTF-8)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = land(
        docs.select(F.col(id_col).alias("doc_id"), F.length(text).alias("points"), without_blanks(text).alias("norm"))
        .select(
            "doc_id",
            "points",
            F.unhex(F.sha2("norm", 256)).alias("digest"),
            F.xxhash64("norm").alias("second"),
            F.length("norm").alias("chars"),
        )
        .withColumn("run", F.pmod(F.xxhash64("doc_id"), F.lit(RUNS)).cast("int")),
        "digests",
    )
    # Smallest first: most code points, an id that is there, the smallest id.
    rank = F.struct((-F.col("points")).alias("a"), F.col("doc_id").isNull().alias("b"), F.col("doc_id").alias("c"))
    levels = [rows.groupBy(*KEY, "run").agg(F.min(rank).alias("best"), F.count("*").alias("size"))]
    runs = RUNS
    while runs > 1:
        runs = -(-runs // FAN)
        below = levels[-1]
        parent = F.floor(F.col("run") / FAN).cast("int").alias("run")
        levels.append(
            below.groupBy(*KEY, parent).agg(F.min("best").alias("best"), F.sum("size").alias("size"))
        )
    won = levels[-1].select(*KEY, F.col("run").alias("parent"), F.col("best.c").alias("keep_id"), F.col("size").alias("group_size"))
    for below in reversed(levels[:-1]):
        step = below.select(*KEY, "run", F.floor(F.col("run") / FAN).cast("int").alias("parent"))
        won = step.join(won, [*KEY, "parent"]).select(
            *KEY, F.col("run").alias("parent"), "keep_id", "group_size"
        )
    return rows.withColumnRenamed("run", "parent").join(won, [*KEY, "parent"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
