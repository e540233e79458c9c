"""Byte strings that recur: threshold-bounded interval expansion on a Burrows-Wheeler transform.

Every string of ``least`` bytes that starts at two places of the corpus (of one text or of
two) is repeated, and each byte under a repeated string is removed. Strings are judged on the
input, all of them, and never cross texts.

**The transform.** Texts of a bounded size have their suffixes sorted and their Burrows-Wheeler
transform taken. An interval of suffixes that share a prefix is extended backward by every
byte before it; that gives the intervals of prefixes one byte longer, and the right end of a
new interval is where neighbouring suffixes share exactly so many bytes. Going breadth-first
from the empty prefix, common prefixes are therefore found by increasing value, and the
expansion stops at ``least``: neighbours without a value by then share ``least`` bytes or more,
and those are the repeated strings. No common prefix beyond ``least`` is ever computed.

**The corpus.** To get equal strings into one transform, each string of ``least`` bytes is keyed
by its anchor, the 48 bytes in it with the least hash (the first of equal ones): equal strings
have equal anchors. Neighbouring strings with one anchor make a *fragment*, of about 70 strings,
and fragments meet by anchor. Anchors that occur once are dropped after one shuffle of
narrow rows; a task tells of an anchor that recurs in its own rows by one row, so a passage in
a third of all documents brings one row a task. Fragments with equal bytes are one fragment
that counts twice. What is left is cut out of its text, and groups of fragments by anchor
are put through the transform, several small groups together.

An anchor with more than ``HOT`` different fragments (a passage in many surroundings) is split:
its strings are divided at the middle of their possible places around the anchor, so that the
halves share more than the anchor, by which they are keyed anew. After eight halvings a
string is keyed by all of its bytes, and then a group has one fragment; so every group ends up
small, and none is ever given up.

Fragments are told apart by 128 bits of hash of their bytes, texts by 86 bits.

Nulls, ties and empties: a null text is the empty one; texts shorter than ``least`` bytes lose
nothing. Rows with equal texts are each other's repeats: both lose everything if they are
long enough. Ids may be null or repeat, each row is judged by its text. A string of one
repeated byte overlaps itself and counts. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rollbook.llm.shared import land, mixed, span_hashes

#: Bytes of an anchor (less where ``least`` is short).
ANCHOR = 48
#: Different fragments from which on an anchor's group is split.
HOT = 256
#: Bytes whose hashes are computed together, and bytes that share a transform.
SCAN, BLOCK = 1 << 17, 1 << 18

PIECE = "m bigint, id bigint, copies bigint, head int, tail int, at int, data binary"


# --- the transform ------------------------------------------------------------------


def suffix_order(symbols: np.ndarray, stop: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order, and their ranks. Symbol 0 ends a fragment and is less than all
    others; of two ends the one of the lesser ``owner`` comes first. ``stop`` is the place of
    the end at or after each place. Ranks by 8 symbols are refined to 24, 72, ..."""
    n = len(symbols)
    padded = np.concatenate((symbols, np.zeros(8, np.uint8)))
    key = np.zeros(n, dtype=np.uint64)
    inside = np.ones(n, dtype=bool)
    for k in range(8):
        inside &= padded[k : k + n] > 0
        key = (key << np.uint64(8)) | np.where(inside, padded[k : k + n], 0).astype(np.uint64)
    active, h = np.arange(n), 0
    group = rank = np.zeros(n, dtype=np.int64)
    while True:
        order = np.argsort(key)
        active, key, group = active[order], key[order], group[order]
        k = np.arange(len(active))
        opens = np.concatenate(([True], group[1:] != group[:-1]))
        new = np.concatenate(([True], key[1:] != key[:-1]))
        rank[active] = group + np.maximum.accumulate(np.where(new, k, 0)) - np.maximum.accumulate(np.where(opens, k, 0))
        tied = ~new
        tied[:-1] |= ~new[1:]
        active = active[tied]
        if not len(active):
            break
        h = 8 if not h else 3 * h
        group, own = rank[active], owner[active]
        once, twice = active + h, active + 2 * h
        in_once, in_twice = once <= stop[active], twice <= stop[active]
        # A suffix that ends within the look-ahead is told apart by its owner.
        second = np.where(in_once, rank[np.minimum(once, n - 1)], own)
        third = np.where(in_twice, rank[np.minimum(twice, n - 1)], np.where(in_once, own, 0))
        key = (group << 42) | (second << 21) | third
    order = np.empty(n, dtype=np.int64)
    order[rank] = np.arange(n)
    return order, rank


def bounded_prefixes(order: np.ndarray, rank: np.ndarray, symbols: np.ndarray, least: int) -> np.ndarray:
    """For each rank: the symbols that the suffix shares with the one before it, or -1 if they
    are ``least`` or more."""
    n = len(order)
    before = np.where(order > 0, symbols[order - 1], 0)
    step = np.where(before > 0, rank[order - 1], -1)  # the suffix that is one symbol longer
    shared = np.full(n + 1, -1, dtype=np.int32)
    shared[n] = 0
    # The transform by stretches of one symbol: an interval's first and last place of each
    # symbol lie in its first and last stretch of that symbol.
    first = np.flatnonzero(np.concatenate(([True], before[1:] != before[:-1])))
    last = np.concatenate((first[1:], [n])) - 1
    stretch = np.repeat(np.arange(len(first)), last - first + 1)
    symbol = before[first]
    by_symbol = np.argsort(symbol.astype(np.int64) * len(first) + np.arange(len(first)))
    same = symbol[by_symbol][1:] == symbol[by_symbol][:-1]
    after = np.full(len(first), len(first) + 1)
    after[by_symbol[:-1][same]] = by_symbol[1:][same]
    ahead = np.full(len(first), -1)
    ahead[by_symbol[1:][same]] = by_symbol[:-1][same]

    # Prefixes of one symbol; each end is a prefix of its own.
    head = symbols[order]
    low = np.flatnonzero(np.concatenate(([True], (head[1:] != head[:-1]) | (head[1:] == 0))))
    shared[low] = 0
    high = np.concatenate((low[1:], [n])) - 1
    for value in range(1, least):
        if not len(low):
            break
        from_, to = stretch[low], stretch[high]
        sizes = to - from_ + 1
        which = np.repeat(np.arange(len(low)), sizes)
        seen = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + from_[which]
        real = symbol[seen] > 0
        closing = real & (after[seen] > to[which])
        opening = real & (ahead[seen] < from_[which])
        # Extended intervals are disjoint, so sorted ends pair up.
        new_high = np.sort(step[np.minimum(last[seen[closing]], high[which[closing]])])
        new_low = np.sort(step[np.maximum(first[seen[opening]], low[which[opening]])])
        unset = shared[new_high + 1] < 0
        low, high = new_low[unset], new_high[unset]
        shared[high + 1] = value
    return shared[:n]


def repeated_starts(fragments: list[bytes], copies: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of repeated strings of ``least`` bytes: fragment, first start, last start."""
    sizes = np.fromiter(map(len, fragments), np.int64, len(fragments)) + 1
    ends = np.cumsum(sizes) - 1
    symbols = np.frombuffer(b"\0".join(fragments) + b"\0", np.uint8) + np.uint8(1)  # UTF-8 has no byte 255
    symbols[ends] = 0
    owner = np.repeat(np.arange(len(fragments)), sizes)
    stop = ends[owner]
    order, rank = suffix_order(symbols, stop, owner)
    shared = bounded_prefixes(order, rank, symbols, least)
    alike = shared < 0
    alike[:-1] |= shared[1:] < 0
    repeated = np.zeros(len(symbols) + 1, dtype=np.int8)
    repeated[order[alike]] = 1
    repeated[:-1] |= (copies[owner] > 1) & (stop - np.arange(len(symbols)) >= least)
    turn = np.diff(repeated, prepend=0)
    opens, closes = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1) - 1
    which = owner[opens]
    base = (ends - sizes + 1)[which]
    return which, opens - base, closes - base


# --- fragments ----------------------------------------------------------------------


def anchors(raw: np.ndarray, k: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``k`` bytes in a row; for each ``width`` of them the place of the least, the
    first of equal ones."""
    at = np.arange(len(raw) - k + 1)
    hashes = span_hashes(raw, at, at + k)
    packed = (hashes >> np.uint64(24) << np.uint64(24)) | at.astype(np.uint64)
    fill = np.full(-len(packed) % width, np.iinfo(np.uint64).max, dtype=np.uint64)
    blocks = np.concatenate((packed, fill)).reshape(-1, width)
    up = np.minimum.accumulate(blocks, axis=1).ravel()
    down = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(packed) - width + 1
    least = np.minimum(down[:n], up[width - 1 : width - 1 + n])
    return hashes, (least & np.uint64((1 << 24) - 1)).astype(np.int64)


def fragments_of(raw: np.ndarray, text: np.ndarray, least: int, k: int):
    """Of texts one after the other (``text`` numbers them): text, first byte, number of
    strings, place of the anchor, anchor and content hash of every fragment."""
    if len(raw) < least:
        return (np.empty(0, np.int64),) * 6
    hashes, place = anchors(raw, k, least - k + 1)
    whole = text[: len(place)] == text[least - 1 :]
    new = np.concatenate(([True], (place[1:] != place[:-1]) | ~whole[:-1])) & whole
    first = np.flatnonzero(new)
    # A fragment ends before the next one, or where strings leave its text.
    gone = np.concatenate((np.flatnonzero(~whole), [len(place)]))
    following = np.concatenate((first[1:], [len(place)]))
    strings = np.minimum(following, gone[np.searchsorted(gone, first)]) - first
    anchor = hashes[place[first]]
    return text[first], first, strings, place[first], anchor, span_hashes(raw, first, first + strings + least - 1)


def _indexer(least: int, k: int):
    def rows(parts: list[tuple[bytes, int, int, int]]) -> tuple[np.ndarray, ...]:
        raw = np.frombuffer(b"".join(p[0] for p in parts), np.uint8)
        sizes = np.fromiter((len(p[0]) for p in parts), np.int64, len(parts))
        begin = np.cumsum(sizes) - sizes
        text, first, strings, _, anchor, content = fragments_of(raw, np.repeat(np.arange(len(parts)), sizes), least, k)
        o = np.fromiter((p[1] for p in parts), np.int64, len(parts))[text]
        x = np.fromiter((p[2] for p in parts), np.int64, len(parts))[text]
        at = first - begin[text] + np.fromiter((p[3] for p in parts), np.int64, len(parts))[text]
        return anchor, content, o, x, at, strings

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, parts, held = [], [], 0
            for value, o, x in zip(batch["text"].cast(pa.binary()), batch["o"].to_pylist(), batch["x"].to_pylist()):
                data = value.as_py()
                # Stretches of a long text overlap by one string less a byte.
                for at in range(0, max(len(data) - least + 1, 1), SCAN):
                    parts.append((data[at : at + SCAN + least - 1], o, x, at))
                    held += len(parts[-1][0])
                    if held >= SCAN:
                        found.append(rows(parts))
                        parts, held = [], 0
            if parts:
                found.append(rows(parts))
            if not found:
                continue
            anchor, content, o, x, at, strings = map(np.concatenate, zip(*found))
            # What recurs in this batch is sure to recur; one row of it tells the others.
            _, one, back, times = np.unique(anchor, return_index=True, return_inverse=True, return_counts=True)
            sure = times[back] > 1
            spread = sure.copy()
            spread[one] = False
            deal = np.where(spread, mixed(content + o.astype(np.uint64) + at.astype(np.uint64)), anchor)
            packed = strings | at << 8 | x << 40 | sure.astype(np.int64) << 62
            arrays = [anchor.view(np.int64), content.view(np.int64), o, packed, deal.view(np.int64)]
            for i in range(0, len(o), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(a[i : i + (1 << 16)]) for a in arrays], ["m", "id", "o", "packed", "deal"])

    return run


def _cutter(least: int, k: int):
    """Texts with a list of wanted fragments -> pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["wanted"]
            wanted = lists.flatten()
            owner = lists.value_parent_indices().to_numpy()
            texts = batch["text"].cast(pa.binary())
            at = wanted.field("at").to_numpy()
            size = wanted.field("strings").to_numpy() + least - 1
            data, last, text = [], -1, b""
            for doc, a, n in zip(owner.tolist(), at.tolist(), size.tolist()):
                if doc != last:
                    last, text = doc, texts[doc].as_py()
                data.append(text[a : a + n])
            zero = np.zeros(len(data), dtype=np.int32)
            arrays = [wanted.field("m"), wanted.field("id"), wanted.field("copies"), pa.array(zero), pa.array(zero + k), pa.array(zero - 1), pa.array(data, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["m", "id", "copies", "head", "tail", "at", "data"])

    return run


def halves(data: bytes, at: int, head: int, tail: int, least: int) -> Iterator[tuple[int, int, int, int, bytes]]:
    """The strings of a fragment in two halves by their place around the anchor at ``at``. All
    of them hold the ``head`` bytes before it and the ``tail`` bytes from it on. Yields the new
    ``head`` and ``tail``, the half's first byte in the fragment, its anchor, its bytes."""
    middle = (head + least - tail) // 2
    for low, high, new in ((middle + 1, least - tail, (middle + 1, tail)), (head, middle, (head, least - middle))):
        # A string whose anchor is its byte j starts at at - j.
        first, last = max(at - high, 0), min(at - low, len(data) - least)
        if first <= last:
            yield *new, first, at - first, data[first : last + least]


def _key(*parts: bytes | int) -> tuple[int, int]:
    h = hashlib.blake2b(b"\0".join(p if isinstance(p, bytes) else b"%d" % p for p in parts), digest_size=16).digest()
    return int.from_bytes(h[:8], "little", signed=True), int.from_bytes(h[8:], "little", signed=True)


def _splitter(least: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for m, id_, copies, head, tail, at, data in zip(*(batch[c].to_pylist() for c in ("m", "id", "copies", "head", "tail", "at", "data"))):
                if at < 0:  # as cut out of its text: the anchor is what its first string has least
                    at = int(anchors(np.frombuffer(data[:least], np.uint8), k, least - k + 1)[1][0])
                for new_head, new_tail, first, new_at, part in halves(data, at, head, tail, least):
                    key = _key(new_head, new_tail, part[new_at - new_head : new_at + new_tail])[0]
                    out.append((key, _key(new_at, part)[0], copies, new_head, new_tail, new_at, part, m, id_, first))
            names = ["m", "id", "copies", "head", "tail", "at", "data", "up_m", "up_id", "first"]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            columns = list(zip(*out)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    return run


def _transformer(least: int):
    """Pieces sorted by anchor -> stretches of repeated strings. A block is whole groups."""

    def found(m: list, ids: list, copies: list, data: list) -> pa.RecordBatch:
        which, first, last = repeated_starts(data, np.array(copies), least)
        arrays = [pa.array(np.array(m, dtype=np.int64)[which]), pa.array(np.array(ids, dtype=np.int64)[which]), pa.array(first), pa.array(last)]
        return pa.RecordBatch.from_arrays(arrays, ["m", "id", "first", "last"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: tuple[list, ...] = ([], [], [], [])
        held = 0
        for batch in batches:
            for m, id_, copies, data in zip(*(batch[c].to_pylist() for c in ("m", "id", "copies", "data"))):
                if held >= BLOCK and m != rows[0][-1]:
                    yield found(*rows)
                    rows, held = ([], [], [], []), 0
                for column, value in zip(rows, (m, id_, copies, data)):
                    column.append(value)
                held += len(data)
        if held:
            yield found(*rows)

    return run


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with the byte ranges under repeated strings -> what is left of them."""
    for batch in batches:
        lists = batch["ranges"]
        out = []
        for k, value in enumerate(batch["text"].cast(pa.binary())):
            data = value.as_py()
            ranges = lists[k].values
            spans: list[list[int]] = []
            if ranges is not None and len(ranges):
                first, last = ranges.field("first").to_numpy(), ranges.field("last").to_numpy()
                by = np.argsort(first, kind="stable")
                first, reach = first[by], np.maximum.accumulate(last[by])
                opens = np.concatenate(([True], first[1:] > reach[:-1]))
                closes = np.concatenate((np.flatnonzero(opens)[1:], [len(first)])) - 1
                spans = [list(s) for s in zip(first[opens].tolist(), reach[closes].tolist())]
            h, done = hashlib.sha256(), 0
            for a, b in spans:
                h.update(data[done:a])
                done = b
            h.update(data[done:])
            out.append((len(data), sum(b - a for a, b in spans), [{"first": a, "end": b} for a, b in spans], h.hexdigest()))
        n_bytes, removed, spans, digest = zip(*out) if out else ([], [], [], [])
        span = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
        arrays = [batch["o"], batch["x"], pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, span), pa.array(digest, pa.string())]
        yield pa.RecordBatch.from_arrays(arrays, ["o", "x", "n_bytes", "n_removed", "spans", "kept_sha256"])


# --- the operator -------------------------------------------------------------------


def _stretches(pieces: DataFrame, least: int) -> DataFrame:
    """``m``, ``id``, ``first``, ``last``: the repeated strings of groups that a task can hold."""
    dealt = pieces.select("m", "id", "copies", "data").repartition("m").sortWithinPartitions("m")
    return dealt.mapInArrow(_transformer(least), "m bigint, id bigint, first bigint, last bigint")


def _hot_anchors(kinds: DataFrame, hot: int) -> DataFrame:
    counted = kinds.groupBy("m").agg(F.count(F.lit(1)).alias("kinds")).where(F.col("kinds") > hot)
    return land(counted.select("m"), "hot-anchors")


def _split(pieces: DataFrame, least: int, k: int, hot: int) -> DataFrame:
    """The repeated strings of groups too large for a task: halved until they are not."""
    halved = land(pieces.mapInArrow(_splitter(least, k), PIECE + ", up_m bigint, up_id bigint, first bigint"), "halves")
    kinds = halved.groupBy("m", "id").agg(
        F.sum("copies").alias("copies"), F.first("head").alias("head"), F.first("tail").alias("tail"),
        F.first("at").alias("at"), F.first("data").alias("data"),
    )
    counted = kinds.groupBy("m").agg(F.count(F.lit(1)).alias("kinds"), F.sum("copies").alias("all"))
    counted = land(counted.where(F.col("all") > 1).select("m", (F.col("kinds") > hot).alias("large")), "anchors")
    kinds = land(kinds.join(counted, "m"), "kinds")
    found = _stretches(kinds.where("NOT large"), least)
    large = kinds.where("large").drop("large")
    if not large.isEmpty():
        found = found.unionByName(_split(large, least, k, hot))
    places = halved.select("m", "id", "up_m", "up_id", F.col("first").alias("by"))
    return land(found, "stretches").join(places, ["m", "id"]).select(
        F.col("up_m").alias("m"), F.col("up_id").alias("id"),
        (F.col("first") + F.col("by")).alias("first"), (F.col("last") + F.col("by")).alias("last"),
    )


def find_repeats(
    docs: DataFrame, least: int = 200, hot: int = HOT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: ``doc_id``, ``n_bytes``, ``n_removed``, ``spans`` (``first``, ``end`` of each stretch of
    removed bytes, end exclusive), ``kept_sha256`` (lower-case hex, of the bytes that are left).
    ``least`` is 2 to 300 bytes."""
    if not 2 <= least <= 300:  # a fragment's strings are counted in a byte
        raise ValueError("least must be 2 to 300 bytes")
    k = max(1, min(ANCHOR, least // 2))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumns({
        "o": F.xxhash64("text"),
        "x": F.xxhash64(F.lit("second"), "text").bitwiseAND((1 << 22) - 1),
    })
    long = rows.where(F.octet_length("text") >= least).select("o", "x", "text")
    index = long.mapInArrow(_indexer(least, k), "m bigint, id bigint, o bigint, packed bigint, deal bigint")
    met = index.withColumn("met", F.count(F.lit(1)).over(Window.partitionBy("deal")))
    sure = F.col("packed").bitwiseAND(1 << 62) != 0
    places = land(
        met.where(sure | (F.col("met") > 1)).select(
            "m", "id", "o",
            F.shiftright("packed", 40).bitwiseAND((1 << 22) - 1).alias("x"),
            F.shiftright("packed", 8).bitwiseAND((1 << 32) - 1).alias("at"),
            F.col("packed").bitwiseAND(255).cast("int").alias("strings"),
        ),
        "fragments",
    )
    kinds = land(
        places.groupBy("m", "id")
        .agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("o", "x", "at", "strings")).alias("one"))
        .select("m", "id", "copies", "one.*"),
        "kinds",
    )
    hot_anchors = _hot_anchors(kinds, hot)

    texts = long.groupBy("o", "x").agg(F.first("text").alias("text"))

    def pieces(some: DataFrame) -> DataFrame:
        wanted = some.groupBy("o", "x").agg(F.collect_list(F.struct("m", "id", "copies", "at", "strings")).alias("wanted"))
        return texts.join(wanted, ["o", "x"]).select("text", "wanted").mapInArrow(_cutter(least, k), PIECE)

    if hot_anchors.isEmpty():
        found = _stretches(pieces(kinds), least)
    else:
        found = _stretches(pieces(kinds.join(hot_anchors, "m", "left_anti")), least)
        found = found.unionByName(_split(pieces(kinds.join(hot_anchors, "m", "left_semi")), least, k, hot))
    ranges = (
        places.join(found, ["m", "id"])
        .select("o", "x", F.struct((F.col("at") + F.col("first")).alias("first"), (F.col("at") + F.col("last") + least).alias("last")).alias("range"))
        .groupBy("o", "x")
        .agg(F.collect_list("range").alias("ranges"))
    )
    judged = texts.join(ranges, ["o", "x"]).mapInArrow(
        _judge, "o bigint, x bigint, n_bytes bigint, n_removed bigint, spans array<struct<first:bigint,end:bigint>>, kept_sha256 string"
    )
    plain = rows.select("doc_id", "o", "x", F.octet_length("text").cast("long").alias("size"), F.sha2("text", 256).alias("sha"))
    return plain.join(judged, ["o", "x"], "left").select(
        "doc_id",
        F.col("size").alias("n_bytes"),
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("spans", F.array().cast("array<struct<first:bigint,end:bigint>>")).alias("spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
    )
