"""The corpus pipeline: documents through five operators, each stage written and read again.

Each stage takes what its predecessor kept. The first four return the columns of documents,
extra ones included; the last returns packed pieces. Each row is judged for itself: a stage
gives its rows keys of their own, so rows without id, or with the same id, do not share a fate.

Nulls, empties, long texts: a null text is the empty one. Texts without letters have no
language and go with the first stage; given to a later stage, the empty ones are copies of
each other, near-duplicates and leaks of nothing, and one end token in a sequence. A text is
one row, of any length, and is judged whole. An empty table gives an empty table at every
stage, and without a benchmark nothing leaks. A null language or source is no evidence.

Stages that run Python set the session to small Arrow batches, if it has no size of its own.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rollbook.llm import decontaminate, exact, language, near, packing
from rollbook.llm.shared import aside, emptied, keyed, land, scratch, table, without
from rollbook.session import fresh_dir, small_batches

#: SQL can express neither the language model nor the packing.
ORACLE_SQL = None


def _rank(key: str) -> Column:
    """Of alike rows the smallest stays: an id that is there, the smallest id, any one row."""
    return F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("id"), F.col(key).alias("row"))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; texts without letters and texts that are like no
    language of the corpus go."""
    small_batches(spark)
    rows, key = keyed(docs)
    found = language.identify_documents(rows.withColumn("doc_id", F.col(key)))
    return without(rows, found.where("NOT kept").select("doc_id"), key).drop(key)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text (white space aside)."""
    rows, key = keyed(docs)
    rank = aside("rank")
    found = exact.duplicates(rows.withColumn(rank, _rank(key)), id_col=rank)
    return without(rows, found.where("NOT kept").select("doc_id.row"), key).drop(key)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles, at a similarity of 0.8."""
    small_batches(spark)
    rows, key = keyed(docs)
    groups = near.near_groups(rows, shingle=5, id_col=key)
    # A group is named by its smallest key, and all its other rows are not kept.
    others = land(groups.where("NOT kept").select(F.col("doc_id").alias(key), "component_id"), "others")
    members = others.unionByName(others.select(F.col("component_id").alias(key), "component_id").distinct())
    best = rows.select(key, "doc_id").join(members, key).groupBy("component_id").agg(F.min(_rank(key)).alias("best"))
    gone = members.select(key).join(land(best.select(F.col("best.row").alias(key)), "best"), key, "left_anti")
    return without(rows, gone, key).drop(key)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaks."""
    small_batches(spark)
    return decontaminate.remove_leaks(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 tokens; each token lies in one of them."""
    small_batches(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language", known_language),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontaminated),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        out = fresh_dir(spark, f"stage-{name.replace(' ', '-')}")
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.schema(docs.schema).parquet(out)
        if before is not None:
            emptied(spark, before)
        before = out
    return STAGES[-1][1](spark, docs, sf_dir)
