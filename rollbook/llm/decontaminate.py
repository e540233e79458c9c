"""Benchmark decontamination by spaced seeds.

Words are runs of letters and digits of any script in lower case; each character of a script
that is written without spaces is a word. A mask looks at six of the words it
spans and ignores the others; the hashes of what the masks see at each position of the
benchmark are joined with those of the documents. Around each hit the document and the item
are laid over each other and compared word by word: an item leaks if, on one alignment, at
least ``IDENTITY`` of the words agree in some window of ``WINDOW`` words (of the whole item,
if that is shorter).

Every window of ``WINDOW`` words with as many substitutions as are tolerated is hit by one
of the masks at some position, whichever words are replaced (a test goes through all
cases), so the search loses nothing that the comparison would accept. Items shorter than
the window are searched by runs of words as well that no allowed set of substitutions can
break up. Items shorter than ``SHORT`` words leak only into documents of the same words;
items without words nowhere.

The benchmark is the side that is sent to the executors, in blocks of about
``BLOCK_WORDS`` words; each block is held against all documents. Documents are not shuffled.

Nulls and empties: null texts on either side are empty and match nothing. Repeated
documents or items each give their rows; of equal alignments the first counts. Extra
columns are ignored; ``remove_leaks`` returns the documents' columns as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rollbook.llm.shared import alnum_hashes, keyed, mixed, texts, tidy, without

#: 1: the word counts, 0: it may be any.
MASKS = ("1110100001001", "1111011", "100101111")
WINDOW, IDENTITY, SHORT = 20, 0.8, 5
BLOCK_WORDS = 500_000
_FILTER_BITS = 22

SCHEMA = "doc_id bigint, item_id bigint, matched bigint, compared bigint, doc_word bigint, item_word bigint, words bigint"


def words_of(text: str) -> np.ndarray:
    return alnum_hashes(text.lower())


def seed_hashes(words: np.ndarray, mask: str) -> np.ndarray:
    """What the mask sees at each position."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.full(n, int(mask, 2) * 64 + len(mask), dtype=np.uint64)
    for i, bit in enumerate(mask):
        if bit == "1":
            out = out * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n]
    return mixed(out)


def tolerated(n: int) -> int:
    """Substitutions allowed in ``n`` words."""
    return n - int(np.ceil(IDENTITY * n - 1e-9))


def masks_for(n: int) -> tuple[str, ...]:
    """Masks for an item of ``n`` words."""
    if n >= WINDOW:
        return MASKS
    # Substitutions leave a run of at least this many words untouched.
    return (*MASKS, "1" * (n // (tolerated(n) + 1)))


class Probe:
    """A block of items with the hashes of their seeds."""

    def __init__(self, items: list[tuple[int, np.ndarray]]):
        self.ids = np.array([-1 if i is None else i for i, _ in items], dtype=np.int64)
        self.unnamed = np.array([i is None for i, _ in items], dtype=bool)
        self.words = [w for _, w in items]
        per: dict[str, list] = {}
        for k, words in enumerate(self.words):
            for mask in masks_for(len(words)):
                h = seed_hashes(words, mask)
                per.setdefault(mask, []).append((h, np.full(len(h), k), np.arange(len(h))))
        self.tables = {}
        for mask, found in per.items():
            h, item, at = (np.concatenate(x) for x in zip(*found))
            order = np.argsort(h, kind="stable")
            seen = np.zeros(1 << _FILTER_BITS, dtype=bool)
            seen[h >> np.uint64(64 - _FILTER_BITS)] = True
            self.tables[mask] = (h[order], item[order], at[order], seen)

    def hits(self, words: np.ndarray) -> set[tuple[int, int]]:
        """Items and alignments (place of the item's first word in the document) to compare."""
        found: set[tuple[int, int]] = set()
        for mask, (keys, item, at, seen) in self.tables.items():
            h = seed_hashes(words, mask)
            place = np.flatnonzero(seen[h >> np.uint64(64 - _FILTER_BITS)])
            if not len(place):
                continue
            left, right = np.searchsorted(keys, h[place]), np.searchsorted(keys, h[place], side="right")
            for p, a, b in zip(place[right > left], left[right > left], right[right > left]):
                found.update(zip(item[a:b].tolist(), (p - at[a:b]).tolist()))
        return found

    def leaks(self, words: np.ndarray) -> list[tuple]:
        """(item, matched, compared, document word, item word) of each leaking item: its best
        window."""
        best: dict[int, tuple] = {}
        for k, offset in sorted(self.hits(words)):
            item = self.words[k]
            n = len(item)
            size = min(WINDOW, n)
            if n < SHORT and (offset != 0 or len(words) != n):
                continue
            first, last = max(0, -offset), min(n, len(words) - offset)
            if last - first < size:
                continue
            same = item[first:last] == words[first + offset : last + offset]
            run = np.concatenate(([0], np.cumsum(same)))
            score = run[size:] - run[:-size]
            at = int(score.argmax())
            if score[at] < size - tolerated(size):
                continue
            row = (int(run[-1]), last - first, first + at + offset, first + at)
            if k not in best or row[0] > best[k][0]:
                best[k] = row
        return [(k, *row, len(self.words[k])) for k, row in best.items()]


def _searcher(probe: Probe):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), texts(batch["text"])):
                for k, *row in probe.leaks(words_of(text)):
                    out.append((doc_id, None if probe.unnamed[k] else int(probe.ids[k]), *row))
            columns = list(zip(*out)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                ["doc_id", "item_id", "matched", "compared", "doc_word", "item_word", "words"],
            )

    return run


def _blocks(benchmark: DataFrame, block_words: int) -> Iterator[Probe]:
    """The benchmark's items, block by block; a block is bounded by the words in it."""
    items = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    # Words are at least one byte and a gap; without a gap, three bytes.
    size = (F.octet_length("text") / 2 + 1).cast("long")
    blocks = int((items.agg(F.sum(size)).first()[0] or 0) // block_words) + 1
    items = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    for block in range(blocks):
        rows = items.where(F.col("block") == block).collect()
        named = sorted(((r["item_id"], r["text"]) for r in rows), key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        held = [(i, words_of(t)) for i, t in named]
        held = [(i, w) for i, w in held if len(w)]
        if held:
            yield Probe(held)


def find_leaks(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document and item that leaks into it: ``doc_id``, ``item_id``, ``matched``
    and ``compared`` (words that agree, and all, on the best alignment), ``doc_word`` and
    ``item_word`` (where its best window starts), ``words`` (the item's)."""
    spark = docs.sparkSession
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    for probe in _blocks(benchmark.select("item_id", "text"), block_words):
        found = read.mapInArrow(tidy(_searcher(probe)), SCHEMA)
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], SCHEMA) if out is None else out


def remove_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents into which no item leaks. Each row is judged for itself, whatever its id."""
    rows, key = keyed(docs)
    found = find_leaks(rows.withColumn("doc_id", F.col(key)), benchmark)
    return without(rows, found.select("doc_id"), key).drop(key)
