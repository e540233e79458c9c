"""Helpers that several operators use: landed tables, word hashes, Arrow output."""

from __future__ import annotations

import contextlib
import ctypes
import itertools
import sys
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import rollbook
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rollbook.session import fresh_dir

# What runs in tasks travels with its code: executors need not have the package.
cloudpickle.register_pickle_by_value(rollbook)


#: What a worker holds for one operator only, and gives up for another: by the key's first part.
LARGE = frozenset({"byte bpe", "counter"})


def _held() -> dict:
    return sys.modules.setdefault("rollbook_worker_state", types.ModuleType("rollbook_worker_state")).__dict__


def per_worker(key: tuple, make: Callable):
    """``make()``, once per Python worker and key; workers outlive tasks."""
    held = _held()
    if key not in held:
        held[key] = make()
    return held[key]


def _trim() -> Callable:
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):  # another C library
        return lambda _: 0


def tidy(run: Callable, keeps: str | None = None) -> Callable:
    """``run``, without what other operators left in the worker (but ``keeps``), giving unused
    memory back to the system when a task ends: workers outlive tasks, and those of earlier
    stages share an executor with those of later ones."""

    def wrapped(batches):
        held = _held()
        for key in [k for k in held if isinstance(k, tuple) and k[0] in LARGE and k[0] != keeps]:
            del held[key]
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        per_worker(("malloc_trim",), _trim)(0)

    return wrapped


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def land(df: DataFrame, label: str) -> DataFrame:
    """The table written to the shared folder and read back: it outlives executors, is
    computed once, and its size is known to whatever joins it."""
    spark = df.sparkSession
    path = fresh_dir(spark, f"llm-{label}")
    if _SCRATCH:
        _SCRATCH[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Tables landed since each open :func:`scratch`.
_SCRATCH: list[list[str]] = []


def emptied(spark: SparkSession, path: str) -> None:
    """Frees the space of a landed table that nothing reads any more."""
    spark.range(0).write.mode("overwrite").parquet(path)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is landed inside is emptied at the end: whatever needs it has to be written by then."""
    _SCRATCH.append([])
    try:
        yield
    finally:
        for path in _SCRATCH.pop():
            emptied(spark, path)


def aside(name: str) -> str:
    """A column name that no caller's column has."""
    return f"__{name}_{uuid.uuid4().hex[:8]}"


def without(docs: DataFrame, gone: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id is not among ``gone`` (one column; null equals null)."""
    key = aside("gone")
    gone = land(gone.toDF(key).distinct(), "gone")
    return docs.join(gone, F.col(id_col).eqNullSafe(F.col(key)), "left_anti")


def keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows with a number of each row's own (ids may be null or repeat), and its column.

    A row of a table of files is numbered by a hash of its file and its place there, which
    every scan finds alike, so the table is not written again; no two rows have one hash, or
    another is taken. Any other rows are landed with a number."""
    key = aside("row")
    plan = getattr(docs, "_jdf", None)  # not there in a remote session
    if plan is not None and plan.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation":
        try:
            for seed in itertools.count():
                rows = docs.withColumn(key, F.xxhash64(F.lit(seed), "_metadata.file_path", "_metadata.row_index"))
                if rows.groupBy(key).count().where("count > 1").isEmpty():
                    return rows, key
        except AnalysisException:  # a source without places of rows
            pass
    return land(docs.withColumn(key, F.monotonically_increasing_id()), "keyed"), key


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is computed once per row, however often it is used: the
    optimizer takes no expression over a generator."""
    return df.select("*", F.inline(F.array(F.struct(value.alias(name)))))


def texts(column: pa.Array):
    """Strings of an Arrow column one by one, null as empty."""
    for value in column:
        yield value.as_py() or ""


# --- words and their hashes, a whole text at a time ---------------------------------

_MIX = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_ODD = 0x9E3779B97F4A7C15
_ALL = (1 << 64) - 1


def mixed(h: np.ndarray) -> np.ndarray:
    """Finaliser: every input bit moves every output bit."""
    h = (h ^ (h >> np.uint64(30))) * _MIX[0]
    h = (h ^ (h >> np.uint64(27))) * _MIX[1]
    return h ^ (h >> np.uint64(31))


_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``n`` powers of an odd number modulo 2^64, and of its inverse."""
    size = 1 << max(16, n.bit_length())
    if size > 1 << 24:
        return _make_powers(size)  # too long to hold on to
    return per_worker(("powers", size), lambda: _make_powers(size))


def _make_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = np.uint64(0xD1342543DE82EF95)
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    up = np.full(n, base, dtype=np.uint64)
    down = np.full(n, inverse, dtype=np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def word_hashes(data: bytes, blank: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words of ``data``, in order. ``blank`` is true for the 256
    byte values that stand between words."""
    raw = np.frombuffer(data, dtype=np.uint8)
    if not len(raw):
        return np.empty(0, dtype=np.uint64)
    edge = np.empty(len(raw) + 2, dtype=bool)
    edge[0] = edge[-1] = True
    edge[1:-1] = blank[raw]
    turns = np.flatnonzero(edge[1:] != edge[:-1])
    return span_hashes(raw, turns[0::2], turns[1::2])


#: Code points of scripts that are written without spaces: Thai, Lao, Tibetan, Myanmar, Khmer,
#: Tai, Kana, Bopomofo, Han, Yi.
_UNSPACED = (
    (0x0E00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF), (0x2E80, 0x2FDF),
    (0x3005, 0x3007), (0x3021, 0x3029), (0x3031, 0x312F), (0x31A0, 0x31BF), (0x31F0, 0x31FF), (0x3400, 0x4DBF),
    (0x4E00, 0xA4CF), (0xA9E0, 0xA9FF), (0xAA60, 0xAADF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x16FE0, 0x18CFF),
    (0x1AFF0, 0x1B2FF), (0x20000, 0x3FFFF),
)


def _kinds() -> np.ndarray:
    """Per code point: 0 is no letter or digit, 1 is one, 2 is a word by itself."""
    out = np.fromiter((chr(c).isalnum() for c in range(0x110000)), dtype=np.uint8, count=0x110000)
    for first, last in _UNSPACED:
        out[first : last + 1] *= 2
    return out


def alnum_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words of a lower-case text: runs of letters and digits of any
    script; a character of a script without spaces is a word."""
    if text.isascii():
        return word_hashes(text.encode(), NOT_ALNUM)
    data = text.encode("utf-8", "replace")
    points = np.frombuffer(data.decode().encode("utf-32-le"), dtype="<u4")
    kind = np.zeros(len(points) + 2, dtype=np.uint8)
    kind[1:-1] = per_worker(("kinds",), _kinds)[points]
    # A word starts after, and ends before, whatever does not run on.
    ran_on = (kind[1:] == 1) & (kind[:-1] == 1)
    inner = kind[1:-1] > 0
    width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    ends = np.cumsum(width)
    first, last = np.flatnonzero(inner & ~ran_on[:-1]), np.flatnonzero(inner & ~ran_on[1:])
    return span_hashes(np.frombuffer(data, dtype=np.uint8), (ends - width)[first], ends[last])


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans ``[start, end)``; equal bytes, equal hash."""
    up, down = _powers(len(raw))
    total = np.empty(len(raw) + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum(_BYTE[raw] * up[: len(raw)], out=total[1:])
    return mixed((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words in order; of the whole sequence if it is shorter;
    none without words."""
    if not len(words):
        return words
    n = min(n, len(words))
    out = np.zeros(len(words) - n + 1, dtype=np.uint64)
    for i in range(n):
        factor = np.uint64(pow(_ODD, i + 1, 1 << 64))
        out += words[i : len(words) - n + 1 + i] * factor
    return mixed(out + np.uint64(n))


def blanks(values: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(values)] = True
    return out


#: Space and the five ASCII controls from tab to carriage return.
WHITE = blanks(b" \t\n\v\f\r")
#: Every ASCII character but digits and lower-case letters.
NOT_ALNUM = blanks(bytes(b for b in range(128) if not (48 <= b < 58 or 97 <= b < 123)))
