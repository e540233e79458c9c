"""Periodic runs, repeated byte strings, resampling: brute force, and odd rows."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from rollbook.llm import periodic, repeats, resample

LONG = "many words of one very long text, again and again. " * 20_000


# --- periodic runs --------------------------------------------------------------------


def runs_by_hand(words, shortest):
    n, least = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(shortest, 3 * q):
                least.setdefault((i, j - i + q), q)
            i = max(i + 1, j)
    return sorted(((s, length, q) for (s, length), q in least.items()), key=lambda r: (r[0], r[2]))


def test_runs_equal_brute_force():
    rng = random.Random(5)
    for _ in range(400):
        shortest, texts = rng.choice([3, 4, 6, 9, 12, 24]), []
        for _ in range(rng.randint(1, 4)):
            n, letters = rng.randint(0, 80), rng.randint(1, 4)
            words = [rng.randint(0, letters) for _ in range(n)]
            if n and rng.random() < 0.6:
                a, p = rng.randrange(n), 1 + n // rng.randint(3, 8)
                words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            if n and rng.random() < 0.3:
                words = words + [9] + words
            texts.append(words)
        flat = np.array([w for t in texts for w in t], dtype=np.int64)
        found = periodic.text_runs(flat, np.array([len(t) for t in texts]), shortest)
        assert found == [runs_by_hand(t, shortest) for t in texts]


def test_runs_of_odd_texts(documents):
    line = "a b c d e f g h"
    rows = [
        (1, None), (2, ""), (3, " \n\t"), (4, "x " * 23), (5, "x\n" * 24), (6, f"{line} " * 3 + "a b"), (6, f"{line} " * 3 + "a b"),
        (None, f"{line} {line} a"), (7, LONG), (8, "y " + "x " * 30 + "y"),
    ]
    got = sorted((r.asDict() for r in periodic.find_runs(documents(rows)).collect()), key=lambda r: (r["doc_id"] or 0, r["n_words"]))
    by = {r["doc_id"]: [tuple(x) for x in r["runs"]] for r in got}
    assert len(got) == 10
    assert by[1] == by[2] == by[3] == by[4] == by[None] == []
    assert by[5] == [(0, 24, 1)] and by[6] == [(0, 26, 8)] and by[7] == [(0, 200_000, 10)] and by[8] == [(1, 30, 1)]
    text = {r["doc_id"]: r["collapsed"] for r in got}
    assert text[5] == "x" and text[6] == line and text[8] == "y x y" and text[1] == text[3] == ""
    assert text[7] == LONG[: LONG.index(".") + 1] and text[None] == f"{line} {line} a"
    assert all((r["best"] is None) == (not r["runs"]) for r in got)
    assert periodic.find_runs(documents([])).collect() == []


def test_the_greatest_run_is_exact():
    assert periodic.greatest([(5, 30, 10), (7, 31, 10), (9, 62, 20)]) == (7, 31, 10)
    assert periodic.greatest([]) is None


# --- repeated byte strings ------------------------------------------------------------


def removed_by_hand(texts, least):
    strings = Counter(t[i : i + least] for t in texts for i in range(len(t) - least + 1))
    out = []
    for t in texts:
        edge = np.zeros(len(t) + 1, dtype=int)
        for i in range(len(t) - least + 1):
            if strings[t[i : i + least]] > 1:
                edge[i] += 1
                edge[i + least] -= 1
        gone = np.cumsum(edge)[: len(t)] > 0
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()))
    return out


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["alpha", "beta", "délta", "x", "中文", "qq"]) + str(rng.randint(0, 99))
    some = lambda n: " ".join(word() for _ in range(n))
    passage, short = some(60), some(12)
    texts = [None, "", "ab" * 200, "a" * 500, "a" * 30, "\x00" * 300]
    for _ in range(150):
        text, kind = some(rng.randint(0, 40)), rng.random()
        if kind < 0.4:
            text += " " + passage[rng.randint(0, 50) :] + some(rng.randint(0, 10))
        elif kind < 0.5:
            text = texts[-1]
        elif kind < 0.7:
            text = some(5) + short + text + short
        texts.append(text)
    return texts


@pytest.mark.parametrize("least, hot", [(200, 256), (40, 3), (200, 2)])
def test_repeats_equal_brute_force(documents, least, hot):
    """Small ``hot`` sends groups through all halvings."""
    texts = corpus(least + hot)
    got = repeats.find_repeats(documents(list(enumerate(texts))), least, hot).collect()
    got = [(r["n_bytes"], r["n_removed"], len(r["spans"]), r["kept_sha256"]) for r in sorted(got, key=lambda r: r["doc_id"])]
    assert got == removed_by_hand([(t or "").encode() for t in texts], least)
    assert sum(g[1] for g in got)


def test_transform_finds_common_prefixes():
    rng = random.Random(3)
    for _ in range(60):
        parts = [bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 40))) for _ in range(rng.randint(1, 8))]
        parts += [parts[0], parts[0][3:] + b"aab"]
        sizes = np.array([len(p) + 1 for p in parts])
        ends = np.cumsum(sizes) - 1
        symbols = np.frombuffer(b"\0".join(parts) + b"\0", np.uint8) + np.uint8(1)
        symbols[ends] = 0
        owner = np.repeat(np.arange(len(parts)), sizes)
        order, rank = repeats.suffix_order(symbols, ends[owner], owner)
        suffix = [bytes(symbols[i : ends[owner[i]]]) for i in range(len(symbols))]
        assert order.tolist() == sorted(range(len(symbols)), key=lambda i: (suffix[i], owner[i]))
        least = rng.choice([2, 5, 12])
        shared = repeats.bounded_prefixes(order, rank, symbols, least)
        for r in range(1, len(order)):
            a, b = suffix[order[r - 1]], suffix[order[r]]
            n = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert shared[r] == (n if n < least else -1)


def test_repeats_of_odd_rows(documents):
    text = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(400))
    rows = [(1, text), (1, text), (None, text[:250]), (2, "z" + text[100:300]), (3, text[:199]), (4, None), (5, LONG[:100_000])]
    got = repeats.find_repeats(documents(rows)).collect()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append((r["n_bytes"], r["n_removed"], [tuple(s) for s in r["spans"]]))
    assert by[1] == [(400, 400, [(0, 400)])] * 2 and by[None] == [(250, 250, [(0, 250)])]
    assert by[2] == [(201, 200, [(1, 201)])] and by[3] == [(199, 0, [])] and by[4] == [(0, 0, [])]
    assert by[5] == [(100_000, 100_000, [(0, 100_000)])]
    assert repeats.find_repeats(documents([])).collect() == []
    with pytest.raises(ValueError):
        repeats.find_repeats(documents([]), least=301)


def test_a_long_text_is_scanned_in_stretches(documents, monkeypatch):
    text = np.random.default_rng(1).integers(97, 123, 20_000, dtype=np.uint8).tobytes()
    text = (text + text[5_000:6_000] + b"!" + text[:300]).decode()
    monkeypatch.setattr(repeats, "SCAN", 1 << 10)
    (row,) = repeats.find_repeats(documents([(1, text)])).collect()
    assert [tuple(s) for s in row["spans"]] == [(0, 300), (5_000, 6_000), (20_000, 21_000), (21_001, 21_301)]


# --- resampling -----------------------------------------------------------------------


def test_run_crcs_equal_the_crcs_of_the_runs():
    rng = random.Random(2)
    texts = ["", None, "Hello, World!! foo", "é ÀB c" * 50, "x" * 5000 + " y", " ".join("w" * rng.randint(1, 300) for _ in range(200))]
    for n in (1, 2, 4):
        words, bucket, text = resample._buckets(pa.array(texts), n, 1 << 31)
        for i, t in enumerate(texts):
            w = resample.words_of((t or "").encode())
            want = [zlib.crc32(b" ".join(w[a : a + k])) % (1 << 31) for k in range(1, n + 1) for a in range(len(w) - k + 1)]
            assert len(w) == words[i] and sorted(bucket[text == i].tolist()) == sorted(want)


def test_resampling_by_hand(documents, frame):
    rng = random.Random(4)
    texts = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(0, 60))) for _ in range(60)] + [None, "", "..."]
    target = ["a bb c a bb c", None, "aaa B"]
    features = lambda t: (w := resample.words_of((t or "").encode())) + [a + b" " + b for a, b in zip(w, w[1:])]
    s, t = (Counter(zlib.crc32(f) % 97 for x in ts for f in features(x)) for ts in (texts, target))
    gain = {b: int(np.floor(1000 * np.log((t[b] + 1) * (s.total() + 97) / ((s[b] + 1) * (t.total() + 97))))) for b in range(97)}
    want = {}
    for i, x in enumerate(texts):
        f = features(x)
        weight = sum(gain[zlib.crc32(y) % 97] for y in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{i}".encode()).hexdigest()[:8], 16)
        want[i] = (len(f), weight, weight + int(np.floor(-1000 * np.log(-np.log((h + 0.5) / 2**32)))))
    able = sorted((-want[i][2], i) for i, x in enumerate(texts) if len(resample.words_of((x or "").encode())) >= 20)
    rank = {i: k + 1 for k, (_, i) in enumerate(able[: 25 * len(able) // 100])}
    rows = resample.resample(documents(list(enumerate(texts))), frame(list(enumerate(target)), "item_id long, text string"), buckets=97).collect()
    assert {r["doc_id"]: (r["n_features"], r["weight"], r["score"], r["rank"]) for r in rows} == {i: (*want[i], rank.get(i)) for i in want}
    assert rank


def test_resampling_odd_rows(documents, frame):
    text = "one two three " * 10
    rows = [(1, text), (1, text), (None, text), (None, None), (2, ""), (3, LONG)]
    none = frame([], "item_id long, text string")
    got = resample.resample(documents(rows), none, percent=100).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == [1, 2, 3, 4] and len(got) == 6
    assert {r["rank"] for r in got if r["doc_id"] == 2} == {None}
    assert resample.resample(documents([]), none).collect() == []
