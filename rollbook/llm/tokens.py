"""Token counts through a cache keyed by content digest and tokenizer version.

The cache is a Parquet table in shared storage: ``digest`` (SHA-256 of the text),
``tokenizer`` (digest of the vocabulary file and its library), ``n_tokens``. Contents
found there are not encoded again; each missing content is encoded once, however many
rows carry it, and appended. A run that is repeated after a failure may append a content
twice, with the same count; readers take one.

Nulls and empties: a null text counts as the empty one (0 bytes, 0 tokens). Every input
row gives one output row, with its id as it is (null too) and no other column of the
input. A text must fit one row; nothing is cut off.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from rollbook.llm.shared import land, texts, tidy
from rollbook.llm.tokenizers_of import counter, version_digest

CACHE = "digest binary, tokenizer string, n_tokens bigint"


def stored_counts(spark: SparkSession, cache: str, version: str) -> DataFrame | None:
    """Digest and count of the contents stored for one tokenizer; None without a cache."""
    try:
        kept = spark.read.schema(CACHE).parquet(cache)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return kept.where(F.col("tokenizer") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def _encoder(path: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = counter(path)
        for batch in batches:
            n = pa.array([library.count(t) for t in texts(batch["text"])], pa.int64())
            yield pa.RecordBatch.from_arrays([batch["digest"], n], ["digest", "n_tokens"])

    return encode


def count_tokens(
    docs: DataFrame, tokenizer: str, cache: str, limit: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` (more than ``limit``) of
    each row. ``tokenizer`` is a vocabulary file that each executor finds at that path."""
    spark, version = docs.sparkSession, version_digest(tokenizer)
    read = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    read = read.withColumn("digest", F.unhex(F.sha2("text", 256)))
    keyed = land(read.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")), "contents")

    known = stored_counts(spark, cache, version)
    # Of equal contents one text per map task travels, so a hot content does not gather.
    contents = read.groupBy("digest").agg(F.first("text").alias("text"))
    misses = contents if known is None else contents.join(known, "digest", "left_anti")
    counted = misses.mapInArrow(tidy(_encoder(tokenizer), keeps="counter"), "digest binary, n_tokens bigint")
    counted.select("digest", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache)

    return keyed.join(stored_counts(spark, cache, version), "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
