"""Importance resampling towards a target corpus, with n-gram hashes from prefix CRCs.

A text is its words with one space between them. It is scanned once, and the running CRC-32
at the end of each word is stored. CRCs are linear over GF(2): for bytes A followed by B,

    crc(AB) = shift(crc(A), |B|) xor crc(B)

where ``shift`` appends that many zero bytes. So the CRC of any run of words is the prefix
that ends with it, xor the prefix before it shifted by the run's length: no n-gram is ever
put together. A shift is four table look-ups; lengths beyond the table go by squares.

Each run of 1 to ``n`` words falls into the bucket of its CRC. A bucket's gain is the floor
of 1000 times the logarithm of its share in the target over its share in the documents, both
smoothed by one count a bucket. A document's weight is the floored mean gain of its runs;
Gumbel noise, drawn from a hash of its id, makes the greatest scores a sample without
replacement in proportion to the weights.

The counts cover all documents; a task sums its own before they are shuffled. What reaches
the driver is one gain per bucket, bounded by the parameter ``buckets``. Ranks come from a
range partitioning by score, so no task holds all scores.

Nulls and ties: a null or wordless text has no runs and weight 0; of equal scores the smaller
id comes first, a null id last (its noise is that of the text ``null``). Rows with the same id
are each scored; between them the order is that of their other values. Without a target, or
without documents, all smoothed shares are equal or there is nothing to score. Extra columns
are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from rollbook.llm.shared import land, per_worker

#: What stands between words: every ASCII character that is no digit and no letter. Letters
#: become lower case.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
#: Shift tables for lengths below 2^SMALL; longer shifts are composed of powers of two.
SMALL = 6
#: Bytes of text whose runs are computed together.
TOGETHER = 1 << 20
_POLY = 0xEDB88320


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ np.where(table & np.uint32(1), np.uint32(_POLY), np.uint32(0))
    return table


def _shift_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The byte table; for each length below 2^SMALL, and for each power of two from there,
    the images of the four bytes of a CRC."""
    byte = _byte_table()
    unit = (np.arange(256, dtype=np.uint32)[None, :] << np.array([[0], [8], [16], [24]], dtype=np.uint32)).ravel()
    small = np.empty((1 << SMALL, 1024), dtype=np.uint32)
    small[0] = unit
    for i in range(1, 1 << SMALL):
        small[i] = (small[i - 1] >> np.uint32(8)) ^ byte[small[i - 1] & np.uint32(255)]
    last = small[-1]
    powers = np.empty((32, 1024), dtype=np.uint32)
    powers[0] = (last >> np.uint32(8)) ^ byte[last & np.uint32(255)]
    for j in range(1, 32):
        powers[j] = _image(powers[j - 1], np.int64(0), powers[j - 1])
    return byte, small.ravel(), powers


def _image(table: np.ndarray, base, crc: np.ndarray) -> np.ndarray:
    """``crc`` under the linear map whose images of bytes start at ``base`` in ``table``."""
    c = crc.astype(np.int64)
    out = table[base + (c & 255)]
    out ^= table[base + 256 + (c >> 8 & 255)]
    out ^= table[base + 512 + (c >> 16 & 255)]
    out ^= table[base + 768 + (c >> 24)]
    return out


def shifted(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The CRCs after as many zero bytes as ``length`` says."""
    _, small, powers = per_worker(("crc shifts",), _shift_tables)
    out = _image(small, (length & ((1 << SMALL) - 1)) << 10, crc)
    rest, j = length >> SMALL, 0
    while rest.any():
        odd = np.flatnonzero(rest & 1)
        out[odd] = _image(powers[j], np.int64(0), out[odd])
        rest, j = rest >> 1, j + 1
    return out


def words_of(data: bytes) -> list[bytes]:
    return data.translate(_FOLD).split()


def running_crcs(words: list[bytes]) -> list[int]:
    """CRC-32 of the space-separated text up to the end of each word, in one scan."""
    if not words:
        return []
    steps = chain(words[:1], map(b" ".__add__, words[1:]))
    return list(accumulate(steps, lambda crc, step: zlib.crc32(step, crc), initial=0))[1:]


def run_crcs(prefixes: np.ndarray, lengths: np.ndarray, docs: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For 1 to ``n`` words: the CRCs of all runs of so many words of one document, and the
    places of their first words. ``prefixes`` are the running CRCs at the words' ends."""
    byte, _, _ = per_worker(("crc shifts",), _shift_tables)
    # The prefix before a word: its predecessor's, one space later; of a first word, nothing.
    state = ~prefixes
    spaced = ~((state >> np.uint32(8)) ^ byte[(state ^ np.uint32(32)) & np.uint32(255)])
    before = np.zeros(len(prefixes), dtype=np.uint32)
    follows = docs[1:] == docs[:-1]
    before[1:][follows] = spaced[:-1][follows]
    ends = np.cumsum(lengths + 1)
    for k in range(1, n + 1):
        at = np.arange(max(len(prefixes) - k + 1, 0))
        at = at[docs[at] == docs[at + k - 1]]
        width = ends[at + k - 1] - ends[at] + lengths[at]
        yield prefixes[at + k - 1] ^ shifted(before[at], width), at


def _buckets(texts: pa.Array, n: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words per text; bucket and text of every run."""
    counts, lengths, prefixes = [], [], []
    for value in texts.cast(pa.binary()):
        words = words_of(value.as_py() or b"")
        counts.append(len(words))
        lengths.extend(map(len, words))
        prefixes.extend(running_crcs(words))
    counts = np.array(counts, dtype=np.int64)
    docs = np.repeat(np.arange(len(counts)), counts)
    found = list(run_crcs(np.array(prefixes, dtype=np.uint32), np.array(lengths, dtype=np.int64), docs, n))
    crcs = np.concatenate([c for c, _ in found])
    return counts, (crcs % np.uint32(buckets)).astype(np.int64), docs[np.concatenate([at for _, at in found])]


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in order, about ``TOGETHER`` bytes of text at a time, or one longer text."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False)
        number = np.cumsum(sizes, dtype=np.int64) // TOGETHER
        edges = np.flatnonzero(np.diff(number, prepend=-1, append=-1))
        for a, b in zip(edges.tolist(), edges[1:].tolist()):
            yield batch.slice(a, b - a)


def bucket_counts(texts: DataFrame, n: int, buckets: int, text_col: str = "text") -> DataFrame:
    """``bucket``, ``n``: runs of 1 to ``n`` words of all texts, repeats counted."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in _stretches(batches):
            total += np.bincount(_buckets(batch["text"], n, buckets)[1], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    each = texts.select(F.col(text_col).alias("text")).mapInArrow(count, "bucket bigint, n bigint")
    return each.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, n: int = 2, buckets: int = 10_000) -> DataFrame:
    """``bucket``, ``gain``: one row for each of the ``buckets``, whatever they hold."""
    spark = docs.sparkSession
    counts = bucket_counts(docs, n, buckets).select("bucket", F.col("n").alias("s"), F.lit(0).alias("t")).unionByName(
        bucket_counts(target, n, buckets).select("bucket", F.lit(0).alias("s"), F.col("n").alias("t"))
    )
    none = spark.range(buckets).select(F.col("id").alias("bucket"), F.lit(0).alias("s"), F.lit(0).alias("t"))
    each = land(counts.unionByName(none).groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")), "buckets")
    whole = each.agg(F.sum("s").cast("double").alias("all_s"), F.sum("t").cast("double").alias("all_t")).first()
    s, t = F.col("s").cast("double"), F.col("t").cast("double")
    ratio = (t + 1) * F.lit(whole["all_s"] + buckets) / ((s + 1) * F.lit(whole["all_t"] + buckets))
    return each.select("bucket", F.floor(1000 * F.log(ratio)).alias("gain"))


def weigh(docs: DataFrame, target: DataFrame, n: int = 2, buckets: int = 10_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``n_features``, ``weight``."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    gain = np.zeros(buckets, dtype=np.int64)
    for row in bucket_gains(docs, target, n, buckets).collect():
        gain[row["bucket"]] = row["gain"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _stretches(batches):
            words, bucket, doc = _buckets(batch["text"], n, buckets)
            features = np.bincount(doc, minlength=len(words)).astype(np.int64)
            total = np.zeros(len(words), dtype=np.int64)
            np.add.at(total, doc, gain[bucket])
            weight = total // np.maximum(features, 1)
            arrays = [batch["doc_id"], pa.array(words), pa.array(features), pa.array(weight)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "n_features", "weight"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, seed: int = 7,
    n: int = 2, buckets: int = 10_000, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Per row: ``doc_id``, ``n_features``, ``weight``, ``score``, ``rank`` (from 1, null where
    not drawn). ``percent`` of the documents of ``min_words`` words or more are drawn,
    rounded down."""
    draw = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))), 256), 1, 8), 16, 10)
    noise = F.floor(-1000 * F.log(-F.log((draw.cast("double") + 0.5) / 4294967296.0)))
    scored = weigh(docs, target, n, buckets, id_col, text_col).withColumn("score", F.col("weight") + noise)
    scored = land(scored, "scored")

    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("weight"), F.asc("n_words")]
    able = scored.where(F.col("n_words") >= min_words)
    # Range partitions in the order of the scores: a row's rank is its place in its
    # partition after all rows of the partitions before.
    dealt = land(able.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "by-score")
    # One row a partition: bounded by their number, like any list of tasks.
    sizes = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("size")).orderBy("part").collect()
    before = list(accumulate((row["size"] for row in sizes), initial=0))
    drawn = percent * before[-1] // 100
    offsets = docs.sparkSession.createDataFrame(
        [(row["part"], first) for row, first in zip(sizes, before)], "part int, before bigint"
    )
    place = F.col("before") + F.row_number().over(Window.partitionBy("part").orderBy(*order))
    dealt = dealt.join(F.broadcast(offsets), "part")
    columns = ["doc_id", "n_features", "weight", "score"]
    ranked = dealt.withColumn("place", place).select(
        *columns, F.when(F.col("place") <= drawn, F.col("place")).cast("bigint").alias("rank")
    )
    return ranked.unionByName(scored.where(F.col("n_words") < min_words).select(*columns, F.lit(None).cast("bigint").alias("rank")))
