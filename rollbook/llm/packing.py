"""Order-preserving packing of documents into token windows.

The documents of a partition, in order of their ids, are one stream of tokens. Cut
positions are chosen by dynamic programming over the ends of documents, the ends of
sentences and a grid of positions within sentences. A window from ``i`` to ``j`` costs the
padding it leaves, a cut costs its penalty:

    f(j) = penalty(j) + min over j - window <= i < j of  f(i) + window - (j - i)

``f(i) + i`` is all of the minimum that depends on ``i``, so the minimum over the sliding
range stands at the head of a monotone queue and each position enters and leaves it once.

A stream is solved in stretches of whole documents of about ``STRETCH`` tokens; only the
last window of a stretch need be padded. Memory is bounded by a stretch, or by the longest
document.

Nulls and empties: a null text is the empty one, which still has its end token. Ids may be
null or repeated; every row is packed once. A partition is sorted by id and text, so that a
repeated task cuts alike. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from rollbook.llm.shared import texts, tidy
from rollbook.llm.tokenizers_of import ByteBpe, byte_bpe

#: Tokens that a stretch holds before it ends with the next document.
STRETCH = 1 << 20
#: Characters of the documents that are turned into tokens together.
TOGETHER = 1 << 21
#: Penalties in tokens of padding: a document goes on in the next window, cut at the end
#: of a sentence, or within one.
AT_SENTENCE, WITHIN = 2, 8
#: Distance of the positions offered within sentences; a power of two, so that full
#: windows in a row stay on the grid.
GRID = 32

SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)


def choose_cuts(places: list[int], penalties: list[int], window: int) -> list[int]:
    """The cut positions of least cost. ``places`` ascend to the stream's end, at most
    ``window`` apart."""
    queue: deque[tuple[int, int, int]] = deque([(0, 0, -1)])  # f(i) + i, i, its index
    best_before = []
    for k, j in enumerate(places):
        reach = j - window
        while queue[0][1] < reach:
            queue.popleft()
        least, _, at = queue[0]
        best_before.append(at)
        value = least + window + penalties[k]  # f(j) + j
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, j, k))
    cuts, k = [], len(places) - 1
    while k >= 0:
        cuts.append(places[k])
        k = best_before[k]
    return cuts[::-1]


def cut_stretch(ids: np.ndarray, doc_ends: np.ndarray, sentence_end: np.ndarray, window: int) -> np.ndarray:
    """Cut positions of a stretch; the last is its end."""
    n = len(ids)
    if not n:
        return np.empty(0, dtype=np.int64)
    cost = np.full(n + 1, -1, dtype=np.int8)
    cost[min(GRID, window) :: min(GRID, window)] = WITHIN
    # After the mark that ends a sentence; its document goes on.
    cost[1:][sentence_end[np.minimum(ids, len(sentence_end) - 1)]] = AT_SENTENCE
    cost[doc_ends] = 0
    cost[0] = -1
    places = np.flatnonzero(cost >= 0)
    return np.asarray(choose_cuts(places.tolist(), cost[places].tolist(), window), dtype=np.int64)


def _pieces(parts: list[bytes], doc_ids: list, sentence_end: np.ndarray, window: int, first: int):
    """Arrow batch of a stretch's pieces, and the number of its windows."""
    data = b"".join(parts)
    lengths = np.fromiter((len(p) // 4 for p in parts), np.int64, len(parts))
    ends = np.cumsum(lengths)
    cuts = cut_stretch(np.frombuffer(data, dtype="<u4"), ends, sentence_end, window)
    edges = np.union1d(cuts, ends)
    starts = np.concatenate(([0], edges[:-1]))
    doc = np.searchsorted(ends, starts, side="right")
    seq = np.searchsorted(cuts, starts, side="right")
    opened = np.concatenate(([0], cuts))
    view = memoryview(data)
    crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(starts.tolist(), edges.tolist())]
    batch = pa.RecordBatch.from_arrays(
        [
            pa.array([doc_ids[d] for d in doc.tolist()], pa.int64()),
            pa.array(starts - (ends - lengths)[doc], pa.int64()),
            pa.array(edges - starts, pa.int64()),
            pa.array(crc, pa.int64()),
            pa.array(lengths[doc], pa.int64()),
            pa.array(first + seq, pa.int64()),
            pa.array(starts - opened[seq], pa.int64()),
        ],
        ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    )
    return batch, len(cuts)


def _encoded(bpe: ByteBpe, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, bytes]]:
    """Id and tokens of each document, in order."""
    doc_ids, held, size = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch["doc_id"].to_pylist(), texts(batch["text"])):
            doc_ids.append(doc_id)
            held.append(text)
            size += len(text)
            if size >= TOGETHER:
                yield from zip(doc_ids, bpe.encode_all(held))
                doc_ids, held, size = [], [], 0
    yield from zip(doc_ids, bpe.encode_all(held))


def _packer(tokenizer: str, end_id: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(tokenizer)
        sentence_end = bpe.sentence_ends()
        end = end_id.to_bytes(4, "little")
        number = TaskContext.get().partitionId() << 40
        parts: list[bytes] = []
        doc_ids: list = []
        held = 0
        for doc_id, ids in _encoded(bpe, batches):
            parts.append(ids + end)
            doc_ids.append(doc_id)
            held += len(parts[-1]) // 4
            if held >= STRETCH:
                out, n = _pieces(parts, doc_ids, sentence_end, window, number)
                yield out
                parts, doc_ids, held, number = [], [], 0, number + n
        if parts:
            yield _pieces(parts, doc_ids, sentence_end, window, number)[0]

    return run


def pack(
    docs: DataFrame, tokenizer: str, window: int = 1024, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece: ``doc_id``, ``start`` (its document's tokens before it), ``length``,
    ``ids_crc32`` (of the ids as little-endian unsigned 32-bit numbers), ``doc_tokens`` (the
    end token included), ``sequence_id``, ``offset`` (in the sequence, without gaps from 0).

    The pieces of a sequence lie in one partition; nothing is shuffled. A sequence id holds
    the partition's number above 2^40."""
    read = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text")
    ).sortWithinPartitions("doc_id", "text")
    return read.mapInArrow(tidy(_packer(tokenizer, end_id, window), keeps="byte bpe"), SCHEMA)
