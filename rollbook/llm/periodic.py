"""Runs of periodic words: maximal pairs from a bottom-up LCP-interval tree.

A run is a stretch of words with smallest period ``q``, at least ``max(shortest, 3 q)`` words
long, that no neighbouring word extends. A maximal pair is two places ``i < j`` of one text
whose next ``m`` words are equal, while the words before them differ (or ``i`` is the first)
and the words after them differ (or the text ends). If ``q = j - i`` and ``m >= 2 q``, the
stretch of ``m + q`` words from ``i`` has period ``q`` and cannot be extended: it is a run, and
each run is such a pair. So nothing is extended; of the pairs that give one stretch, the one
with the smallest distance is its period.

Pairs are enumerated on the tree of LCP intervals, from the longest common prefixes down. A
node has the places that share its prefix, in order, each with the class of the word on its
left. When children meet, each place of the smaller one looks for partners in the other
child's list within half the prefix's length, of another left class. Places that near are an
arithmetic progression (the prefix overlaps itself), in which all but the first have the
same word on the left; so there is at most one partner on either side, found by bisection,
and the work is the places times the logarithm of their number plus the pairs.

Only places whose next ``floor`` words recur in the same text are sorted to the end and
enter the tree; ``floor = min over q of max(2 q, shortest - q)`` is the least ``m`` of any run.
Suffixes are sorted by prefix doubling, many texts at once, each text for itself.

A text is one task's work; tasks hold a few million words, or one longer text.

Nulls and empties: a null, empty or blank text has no words and no runs. Rows may share an
id, each is judged for itself. Extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Words that are sorted together, unless one text has more.
TOGETHER = 1 << 18

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def least_match(shortest: int) -> int:
    """The fewest words that a run's two copies, a period apart, have in common."""
    return min(max(2 * q, shortest - q) for q in range(1, shortest + 1))


def sorted_levels(ids: np.ndarray, ends: np.ndarray, floor: int) -> tuple[list[tuple[int, np.ndarray]], np.ndarray]:
    """Ranks of the suffixes by their first 1, 2, 4, ... words, and the places whose first
    ``floor`` words (rounded down to a power of two) recur, in suffix order.

    ``ids`` are words, different in different texts; ``ends`` has for each place the end of
    its text. A place whose words are unique at one level keeps its rank at the next ones.
    """
    n = len(ids)
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64)
    # A rank is the place of its group's first member among all suffixes.
    first = np.concatenate(([0], np.cumsum(np.bincount(rank))[:-1])) if n else rank
    rank = first[rank]
    active = np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)
    levels, kept, h = [(1, rank)], active if floor < 2 else None, 1
    while len(active):
        ahead = active + h
        inside = ahead < ends[active]
        # One place at most of a group ends with its text here; it comes first.
        after = np.where(inside, rank[np.minimum(ahead, n - 1)] + 1, 0)
        order = np.argsort(rank[active] * (n + 1) + after)
        active, after = active[order], after[order]
        group = rank[active]
        k = np.arange(len(active))
        new_group = np.concatenate(([True], group[1:] != group[:-1]))
        new = new_group | np.concatenate(([True], after[1:] != after[:-1]))
        opened = np.maximum.accumulate(np.where(new, k, 0))
        rank = rank.copy()
        rank[active] = group + opened - np.maximum.accumulate(np.where(new_group, k, 0))
        h *= 2
        levels.append((h, rank))
        more = ~new
        more[:-1] |= ~new[1:]
        active = active[more]
        if kept is None and 2 * h > floor:
            kept = active
    kept = np.empty(0, dtype=np.int64) if kept is None else kept
    return levels, kept[np.argsort(rank[kept])]


def common_prefixes(levels: list[tuple[int, np.ndarray]], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Words in common from the places ``a`` and ``b``, from the ranks of all levels."""
    n = len(levels[0][1])
    out = np.zeros(len(a), dtype=np.int64)
    for h, rank in reversed(levels):
        i, j = a + out, b + out
        inside = (i < n) & (j < n)
        same = inside & (rank[np.minimum(i, n - 1)] == rank[np.minimum(j, n - 1)])
        out += h * same
    return out


def maximal_pairs(places: list[int], lcp: list[int], left: list[int], shortest: int) -> Iterator[tuple[int, int, int]]:
    """``(i, j, m)`` of the maximal pairs with ``2 (j - i) <= m`` and ``m + j - i >= shortest``.
    ``places`` are in suffix order, ``lcp[k]`` is what places ``k - 1`` and ``k`` have in common,
    ``left[k]`` the class of the word before place ``k``."""
    before = dict(zip(places, left))

    def partners(i: int, mine: int, others: list[int], m: int) -> Iterator[tuple[int, int]]:
        at = bisect_left(others, i - m // 2)
        if at < len(others) and others[at] < i and before[others[at]] != mine:
            yield others[at], i
        at = bisect_right(others, i)
        # All of a progression but its first have one word on the left: the first seen
        # tells for all.
        while at < len(others) and others[at] - i <= m // 2 and before[others[at]] != mine:
            yield i, others[at]
            at += 1

    def meet(one: list[int], other: list[int], m: int) -> Iterator[tuple[int, int, int]]:
        """Pairs between two children; the larger list takes up the smaller one."""
        for i in one:
            for a, b in partners(i, before[i], other, m):
                if m + b - a >= shortest:
                    yield a, b, m
        for i in one:
            insort(other, i)

    # Open nodes: prefix length and places, the deepest last; ``child`` is the completed
    # subtree before the next place.
    stack: list[tuple[int, list[int]]] = []
    child = places[:1]
    for k in range(1, len(places) + 1):
        shared = lcp[k] if k < len(places) else 0
        while stack and stack[-1][0] > shared:
            depth, node = stack.pop()
            small, child = sorted((child, node), key=len)
            yield from meet(small, child, depth)
        if shared and stack and stack[-1][0] == shared:
            small, node = sorted((child, stack.pop()[1]), key=len)
            yield from meet(small, node, shared)
            stack.append((shared, node))
        elif shared:
            stack.append((shared, child))
        child = places[k : k + 1]


def runs_of(pairs: Iterator[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` by start, then period: of the pairs that make one stretch,
    the one with the smallest distance."""
    least: dict[tuple[int, int], int] = {}
    for i, j, m in pairs:
        key = i, m + j - i
        least[key] = min(least.get(key, j - i), j - i)
    return sorted(((start, length, q) for (start, length), q in least.items()), key=lambda r: (r[0], r[2]))


def text_runs(words: np.ndarray, counts: np.ndarray, shortest: int) -> list[list[tuple[int, int, int]]]:
    """The runs of each text. ``words`` are numbers, text after text, ``counts`` of each."""
    stops = np.cumsum(counts)
    starts = stops - counts
    doc = np.repeat(np.arange(len(counts)), counts)
    floor = least_match(shortest)
    levels, kept = sorted_levels(doc * (int(words.max(initial=0)) + 1) + words, stops[doc], floor)
    out: list[list] = [[] for _ in counts]
    if not len(kept):
        return out
    lcp = np.concatenate(([0], common_prefixes(levels, kept[:-1], kept[1:])))
    lcp[lcp < floor] = 0
    owner = doc[kept]
    left = np.where(kept == starts[owner], -1, words[kept - 1])
    # Suffixes of one text need not lie together; trees do, so they are cut where nothing
    # is shared, and their pairs are told apart by the text of their places.
    edges = np.concatenate((np.flatnonzero(lcp == 0), [len(kept)])).tolist()
    pairs: dict[int, list] = {}
    for a, b in zip(edges, edges[1:]):
        if b - a > 1:
            at = int(owner[a])
            found = maximal_pairs((kept[a:b] - starts[at]).tolist(), lcp[a:b].tolist(), left[a:b].tolist(), shortest)
            pairs.setdefault(at, []).extend(found)
    for at, found in pairs.items():
        out[at] = runs_of(found)
    return out


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words are in no run after that run's first period."""
    edge = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return np.cumsum(edge[:n]) == 0


def greatest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of greatest exact length over period; of equal ones the first."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def _finder(shortest: int):
    def rows(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
        number: dict[bytes, int] = {}
        counts = np.array([len(t) for t in texts], dtype=np.int64)
        words = np.fromiter(
            (number.setdefault(w, len(number)) for t in texts for w in t), dtype=np.int64, count=int(counts.sum())
        )
        found = text_runs(words, counts, shortest)
        collapsed = []
        for text, runs in zip(texts, found):
            if runs:
                text = [text[i] for i in np.flatnonzero(kept_words(len(text), runs)).tolist()]
            collapsed.append(b" ".join(text))
        named = [[dict(zip(("start", "length", "period"), r)) for r in runs] for runs in found]
        struct = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        best = [None if b is None else dict(zip(("start", "length", "period"), b)) for b in map(greatest, found)]
        return pa.RecordBatch.from_arrays(
            [
                pa.concat_arrays(ids),
                pa.array(counts),
                pa.array(named, pa.list_(struct)),
                pa.array(best, struct),
                pa.array(collapsed, pa.binary()).cast(pa.string()),
            ],
            ["doc_id", "n_words", "runs", "best", "collapsed"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, held = [], [], 0
        for batch in batches:
            for k, value in enumerate(batch["text"].cast(pa.binary())):
                ids.append(batch["doc_id"].slice(k, 1))
                texts.append((value.as_py() or b"").split())
                held += len(texts[-1])
                if held >= TOGETHER:
                    yield rows(ids, texts)
                    ids, texts, held = [], [], 0
        if texts:
            yield rows(ids, texts)

    return run


def find_runs(docs: DataFrame, shortest: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``runs`` (``start``, ``length``, ``period`` in words, by start,
    then period), ``best`` (the run of greatest length over period, null without runs) and
    ``collapsed``: the words, with one space between them, that no run contains after its first
    period. Words are what stands between ASCII white space."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(
        _finder(shortest),
        f"doc_id {kind}, n_words bigint, runs {RUNS}, best struct<start:bigint,length:bigint,period:bigint>, collapsed string",
    )
