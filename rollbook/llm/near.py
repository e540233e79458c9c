"""Near-duplicates: bottom-k sketches, inverted lists, union sketches, exact Jaccard.

1. A document's shingles (runs of words) are hashed with one hash function; its sketch is
   the ``SKETCH`` smallest values. Documents with the same shingle set are one class from
   here on, named by its smallest id.
2. Inverted lists of retained values give candidates. If a pair's similarity is at least
   the threshold, all but a vanishing share of the time (six standard deviations) its
   sketches overlap in ``LEAST`` of the values that the larger one retains. Two sets that
   overlap so much share one of their rarest values already, if each leaves out only as
   many of its most frequent values as the overlap allows (prefix filtering). So a class
   enters only the lists of its rarest retained values: passages that many documents share
   make no lists, and a document whose rare values are all its own makes none.
3. Lists of up to ``SMALL`` classes give all their pairs. A longer list is a tree of stars:
   it is dealt into groups of about ``SMALL``, each member pairs with the group's hub, and
   hubs pair on in the same way. That connects a group of copies with as many pairs as it
   has members; what it may leave open is settled in step 6.
4. Pairs whose sizes allow a link are estimated: of the smallest values of both sketches
   together, the share that both retain.
5. Links are confirmed on full shingle sets, first one pair per class (the best estimated
   to a smaller id), then all that still lie between different components.
6. A long list whose members are in different components then is dealt anew by second
   values: a pair whose rarest common value is the list's shares a later one too, if each
   looks one value further. A long list of classes that have no more in common than its
   value falls apart into short ones, which give their pairs of different components.
   What is long still is a group that is alike but not all linked. Such a group has a
   centre, the shingles that more than half of its members have, and a member is held as
   its difference to the centre: two members differ in what both differences hold, less
   twice what they have in common. So without a common difference their sizes alone decide;
   by these, each member that links with any links with the one nearest the centre, and
   those links need no pairs. The others link only with members that share a difference,
   and meet them in the lists of their rarest ones, where their places leave room for as
   many as a link needs. Classes far from every centre are put in order of rarity on their
   full sets, and meet in the lists of the values that the threshold itself allows. So each
   link of step 2's candidates is confirmed or lies inside a component, and components are
   what all links would give.

Every table between the steps is written to the shared folder. Joins that may meet a hot
key (a common value, a hub, a large class) are equality joins that adaptive execution
splits; sums are reduced on the map side first.

Nulls, empties, ties: a null text is the empty one; without words the shingle set is empty
and the document is alone. Fewer words than a shingle are one shingle. A row without id
takes the component of an equal set that has one, else none, and then is kept. Rows that
repeat an id repeat its text and share its result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rollbook.llm.shared import WHITE, land, shingle_hashes, texts, tidy, word_hashes

SKETCH, SMALL = 48, 16


def least_overlap(threshold: int) -> float:
    """The share of a sketch that a pair at the threshold overlaps in, less six standard
    deviations."""
    t = threshold / 100
    return max(0.05, t - 6 * math.sqrt(t * (1 - t) / SKETCH))


def shingle_set(text: str, shingle: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a text: words between ASCII white space, A-Z in
    lower case."""
    return np.unique(shingle_hashes(word_hashes(text.encode("utf-8", "surrogatepass").lower(), WHITE), shingle))


def _sketcher(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, sketches = [], [], []
            for text in texts(batch["text"]):
                values = shingle_set(text, shingle)
                sizes.append(len(values))
                digests.append(hashlib.blake2b(values.tobytes(), digest_size=16).digest())
                # In signed order, as the JVM compares.
                sketches.append((values[:SKETCH] ^ np.uint64(1 << 63)).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(sketches, pa.list_(pa.int64())),
                ],
                ["doc_id", "n", "digest", "sketch"],
            )

    return run


def _postings(classes: DataFrame, threshold: int) -> tuple[DataFrame, DataFrame]:
    """``value``, ``m`` (length of its list), ``rep``, ``n``: each class in the lists of its
    rarest retained values. And ``rep``, ``values``: these values in order of rarity, and
    one more."""
    each = classes.select("rep", "n", F.size("sketch").alias("k"), F.explode("sketch").alias("value"))
    spread = each.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    shared = each.join(spread, "value")
    # Values of its own are the rarest of a class; they take up places without a list.
    mine = shared.groupBy("rep", "n", "k").agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("values"))
    # Sets that fit a sketch with all their partners overlap as the similarity itself says.
    t = threshold / 100
    share = F.when(F.col("n") <= int(SKETCH * t), t).otherwise(least_overlap(threshold))
    quota = F.size("values") - F.ceil(F.col("k") * share - 1e-9) + 1
    rare = mine.withColumn("quota", quota.cast("int")).where("quota > 0")
    values = F.transform(F.expr("slice(values, 1, quota + 1)"), lambda v: v["value"])
    rare = land(rare.select("rep", "n", "quota", values.alias("values")), "rare")
    each = rare.select("rep", "n", F.explode(F.expr("slice(values, 1, quota)")).alias("value"))
    length = each.groupBy("value").agg(F.count("*").alias("m")).where("m > 1")
    return land(each.join(length, "value"), "lists"), rare.select("rep", "values")


def _sized(pairs: DataFrame, threshold: int) -> DataFrame:
    """Pairs whose sizes allow the similarity, each once, smaller id first."""
    fits = 100 * F.least("n1", "n2") >= threshold * F.greatest("n1", "n2")
    pairs = pairs.where((F.col("r1") != F.col("r2")) & fits)
    return pairs.select(F.least("r1", "r2").alias("a"), F.greatest("r1", "r2").alias("b")).distinct()


def _two(df: DataFrame, i: int, *keys: str) -> DataFrame:
    return df.select(*keys, F.col("rep").alias(f"r{i}"), F.col("n").alias(f"n{i}"))


def _candidates(lists: DataFrame, threshold: int) -> DataFrame:
    small = lists.where(F.col("m") <= SMALL)
    left, right = _two(small, 1, "value"), _two(small, 2, "value")
    pairs = left.join(right, "value").where("r1 < r2").select("r1", "n1", "r2", "n2")

    level = lists.where(F.col("m") > SMALL).withColumn("groups", F.ceil(F.col("m") / SMALL))
    longest = level.agg(F.max("groups")).first()[0] or 0
    level = level.withColumn("group", F.pmod(F.xxhash64("rep", "value"), F.col("groups"))).select("value", "group", "rep", "n")
    while longest:
        hub = F.min(F.struct(F.xxhash64("value", "rep").alias("h"), "rep", "n")).alias("hub")
        hubs = level.groupBy("value", "group").agg(hub).select("value", "group", "hub.rep", "hub.n")
        stars = _two(level, 1, "value", "group").join(_two(hubs, 2, "value", "group"), ["value", "group"])
        pairs = pairs.unionByName(stars.select("r1", "n1", "r2", "n2"))
        if longest == 1:
            break
        level = hubs.withColumn("group", F.floor(F.col("group") / SMALL))
        longest = -(-longest // SMALL)
    return _sized(pairs, threshold)


def _estimated(pairs: DataFrame, sketches: DataFrame, least: float) -> DataFrame:
    """Pairs with ``estimate``, of those whose union sketch is shared enough."""
    pairs = pairs.join(sketches.select(F.col("rep").alias("a"), F.col("sketch").alias("sa")), "a")
    pairs = pairs.join(sketches.select(F.col("rep").alias("b"), F.col("sketch").alias("sb")), "b")
    union = F.slice(F.sort_array(F.array_union("sa", "sb")), 1, SKETCH)
    both = F.size(F.array_intersect(F.array_intersect("sa", "sb"), union))
    estimate = both / F.size(union)
    return pairs.select("a", "b", estimate.alias("estimate")).where(F.col("estimate") >= least)


def _confirmer(shingle: int, threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for one, other in zip(texts(batch["ta"]), texts(batch["tb"])):
                x, y = shingle_set(one, shingle), shingle_set(other, shingle)
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= threshold * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"], pa.array(linked, pa.bool_())], ["a", "b", "linked"])

    return run


def _confirmed(pairs: DataFrame, held: DataFrame, shingle: int, threshold: int) -> DataFrame:
    pairs = pairs.join(held.select(F.col("rep").alias("a"), F.col("text").alias("ta")), "a")
    pairs = pairs.join(held.select(F.col("rep").alias("b"), F.col("text").alias("tb")), "b")
    return pairs.select("a", "b", "ta", "tb").mapInArrow(
        tidy(_confirmer(shingle, threshold)), "a bigint, b bigint, linked boolean"
    )


def _is_settled(edges: DataFrame) -> bool:
    """Whether each id has one edge upwards and no id has edges both ways: all stars."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(edges.select(F.col("v").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    each = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return each.where("up > 1 OR up > 0 AND down > 0").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``u``, ``root`` (the smallest id it reaches) for each id that is not its own root.
    ``edges``: ``a``, ``b``. Alternating large and small stars, each a join with the
    smallest neighbour."""
    edges = land(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "edges"
    )
    while not _is_settled(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).where("u != v").distinct()
        edges = land(small, "stars")
    return edges.select("u", F.col("v").alias("root"))


def _rooted(df: DataFrame, roots: DataFrame, column: str, name: str) -> DataFrame:
    """Adds the component of ``column``."""
    table = roots.select(F.col("u").alias(column), F.col("root").alias(name))
    joined = df.join(table, column, "left")
    return joined.withColumn(name, F.coalesce(name, column))


def _sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group, rep, root, text in zip(*(batch[c].to_pylist() for c in ("group", "rep", "root")), texts(batch["text"])):
                values = shingle_set(text, shingle)
                n = len(values)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x] * n, pa.int64()) for x in (group, rep, root, n)] + [pa.array(values.view(np.int64))],
                    ["group", "rep", "root", "n", "value"],
                )

    return run


def _differences(shingle: int):
    """Members with their group's centre -> the values that only one of the two has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, differ = [], []
            for centre, text in zip(batch["centre"], texts(batch["text"])):
                values = shingle_set(text, shingle).view(np.int64)
                middle = np.asarray([], np.int64) if centre.values is None else centre.values.to_numpy()
                sizes.append(len(values))
                differ.append(np.setxor1d(values, middle))
            yield pa.RecordBatch.from_arrays(
                [batch["group"], batch["rep"], batch["root"], pa.array(sizes, pa.int64()), pa.array(differ, pa.list_(pa.int64()))],
                ["group", "rep", "root", "n", "differ"],
            )

    return run


def _grouped(long: DataFrame) -> DataFrame:
    """``rep``, ``group``: classes with the ones of their longest list. A list is named by its
    smallest class, which may be in a longer list itself: its name counts then, in two steps.
    ``long``: ``value``, ``rep``."""
    each = long.select("value", "rep").distinct()
    lists = each.groupBy("value").agg(F.count("*").alias("m"), F.min("rep").alias("hub"))
    longest = each.join(lists, "value").groupBy("rep").agg(F.max(F.struct("m", "value", "hub")).alias("best"))
    hubs = land(longest.select("rep", F.col("best.hub").alias("hub")), "hubs")
    above = hubs.select(F.col("rep").alias("hub"), F.col("hub").alias("next"))
    group = hubs
    for _ in range(2):
        group = group.join(above, "hub").select("rep", F.col("next").alias("hub"))
    return group.withColumnRenamed("hub", "group")


def _around_centres(each: DataFrame, members: DataFrame, shingle: int, threshold: int) -> DataFrame:
    """Members near their group's centre: ``group``, ``rep``, ``root``, ``differ`` and ``slack``, by
    which two of them without a common difference are linked if their sum is not above 0.

    Of two sets with sizes ``S`` together, of which ``D`` values are in one only, the similarity
    is (S - D) / (S + D). It reaches the threshold if (100 + threshold) D <= (100 - threshold) S."""
    size = members.groupBy("group").agg(F.count("*").alias("size"))
    held = each.groupBy("group", "value").agg(F.count("*").alias("df"))
    centre = held.join(size, "group").where(2 * F.col("df") > F.col("size"))
    centre = land(centre.groupBy("group").agg(F.collect_list("value").alias("centre")), "centres")
    differ = members.join(centre, "group").select("group", "rep", "root", "centre", "text").mapInArrow(
        tidy(_differences(shingle)), "group bigint, rep bigint, root bigint, n bigint, differ array<bigint>"
    )
    slack = (100 + threshold) * F.size("differ") - (100 - threshold) * F.col("n")
    return land(differ.where(2 * F.size("differ") <= F.col("n")).withColumn("slack", slack.cast("long")), "around-centres")


def _linked_by_size(near: DataFrame) -> DataFrame:
    """Links that the sizes of differences decide: of each group, to its member of least slack."""
    best = near.groupBy("group").agg(F.min(F.struct("slack", "rep")).alias("best"))
    both = near.join(best, "group").where((F.col("slack") + F.col("best.slack") <= 0) & (F.col("rep") != F.col("best.rep")))
    return both.select(F.least("rep", "best.rep").alias("a"), F.greatest("rep", "best.rep").alias("b"))


def _by_differences(near: DataFrame, roots: DataFrame, threshold: int) -> DataFrame:
    """Pairs of different components that share enough of their differences. ``roots``: the
    components once the links by size are in."""
    best = near.groupBy("group").agg(F.min("slack").alias("least"))
    near = _rooted(near.drop("root"), roots, "rep", "root").join(best, "group")
    each = near.select("group", "rep", "root", "slack", "least", F.explode("differ").alias("value"))
    spread = each.groupBy("group", "value").agg(
        F.count("*").alias("df"), F.min("root").alias("lo"), F.max("root").alias("hi")
    ).where("df > 1")
    ranked = each.join(spread, ["group", "value"]).groupBy("group", "rep", "root", "slack", "least").agg(
        F.sort_array(F.collect_list(F.struct("df", "value", (F.col("lo") != F.col("hi")).alias("open")))).alias("values")
    )
    # ``left``: shared values from this one on, the most that a pair can share if it is their first.
    at = ranked.select("group", "rep", "root", "slack", "least", F.size("values").alias("k"), F.posexplode("values").alias("at", "v"))
    lists = land(
        at.where("v.open").select("group", "rep", "root", "slack", "least", (F.col("k") - F.col("at")).alias("left"), "v.value"), "difference-lists"
    )
    twice = 2 * (100 + threshold)
    far = lists.where(F.col("slack") + F.col("least") > 0).where(twice * F.col("left") >= F.col("slack") + F.col("least"))
    one = far.select("group", "value", F.col("rep").alias("r1"), F.col("root").alias("c1"), F.col("slack").alias("s1"), F.col("left").alias("l1"))
    other = lists.select("group", "value", F.col("rep").alias("r2"), F.col("root").alias("c2"), F.col("slack").alias("s2"), F.col("left").alias("l2"))
    room = twice * F.least("l1", "l2") >= F.col("s1") + F.col("s2")
    pairs = one.join(other, ["group", "value"]).where((F.col("c1") != F.col("c2")) & room)
    return pairs.select(F.least("r1", "r2").alias("a"), F.greatest("r1", "r2").alias("b"))


def _within_groups(each: DataFrame, near: DataFrame, threshold: int) -> DataFrame:
    """Pairs of different components that full sets allow a link, of which not both are around
    one centre. ``each``: ``group``, ``rep``, ``root``, ``n``, ``value``."""
    t = threshold / 100
    close = near.select("rep", F.lit(True).alias("close"))
    each = each.join(close, "rep", "left").withColumn("close", F.coalesce("close", F.lit(False)))
    spread = each.groupBy("value").agg(
        F.count("*").alias("df"), F.min("root").alias("lo"), F.max("root").alias("hi"),
        (F.min("group") != F.max("group")).alias("mixed"), F.min("close").alias("all_close"),
    ).where("df > 1")
    is_open = (F.col("lo") != F.col("hi")) & (F.col("mixed") | ~F.col("all_close"))
    shared = each.join(spread, "value").groupBy("group", "rep", "root", "n", "close").agg(
        F.sort_array(F.collect_list(F.struct("df", "value", is_open.alias("open")))).alias("values")
    )
    # ``left``: values from this one on, the most that a pair can share if it is their first.
    shared = shared.select("group", "rep", "root", "n", "close", F.size("values").alias("k"), F.posexplode("values").alias("at", "v"))
    shared = shared.select("group", "rep", "root", "n", "close", (F.col("k") - F.col("at")).alias("left"), "v.value", "v.open")
    shared = land(shared.where(F.col("open") & (F.col("left") >= F.col("n") * t - 1e-9)), "set-lists")
    one, other = (
        shared.select(
            "value", *(F.col(c).alias(f"{c[0]}{i}") for c in ("rep", "n", "left", "group")),
            F.col("root").alias(f"c{i}"), F.col("close").alias(f"close{i}"),
        )
        for i in (1, 2)
    )
    room = F.least("l1", "l2") >= t / (1 + t) * (F.col("n1") + F.col("n2")) - 1e-9
    apart = (F.col("g1") != F.col("g2")) | ~F.col("close1") | ~F.col("close2")
    return _sized(one.join(other, "value").where((F.col("c1") < F.col("c2")) & room & apart), threshold)


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """The components once ``links`` (``a``, ``b``) are in: only the components that these connect
    are put together, each as its smallest id."""
    between = _rooted(_rooted(links, roots, "a", "ca"), roots, "b", "cb").where("ca != cb")
    above = components(between.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    lifted = _rooted(roots.withColumnRenamed("root", "below"), above, "below", "root").select("u", "root")
    return land(lifted.unionByName(above), "roots")


def _settle(pairs: DataFrame, roots: DataFrame, held: DataFrame, shingle: int, threshold: int) -> DataFrame:
    """Confirms pairs, first one per class, then all that still lie between components;
    returns the components that their links make of those in ``roots``."""
    for first in (True, False):
        between = _rooted(_rooted(pairs, roots, "a", "ca"), roots, "b", "cb").where("ca != cb")
        pairs = land(between.select("a", "b", "estimate"), "between")
        if pairs.isEmpty():
            break
        now = pairs
        if first:
            best = F.max(F.struct("estimate", (-F.col("a")).alias("a"))).alias("best")
            now = pairs.groupBy("b").agg(best).select((-F.col("best.a")).alias("a"), "b", "best.estimate")
        tested = land(_confirmed(now, held, shingle, threshold), "tested")
        linked = tested.where("linked").select("a", "b")
        if not linked.isEmpty():
            roots = _merged(roots, linked)
        pairs = pairs.join(tested.select("a", "b"), ["a", "b"], "left_anti")
    return roots


def near_groups(
    docs: DataFrame, shingle: int, threshold: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: ``doc_id``, ``n_shingles``, ``component_id`` (smallest id that links reach),
    ``kept`` (the row's id is its component's). Documents are linked if the Jaccard
    similarity of their shingle sets is at least ``threshold`` per cent."""
    least = least_overlap(threshold)
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = land(
        read.mapInArrow(tidy(_sketcher(shingle)), "doc_id bigint, n bigint, digest binary, sketch array<bigint>"), "sketches"
    )
    found = rows.where("n > 0").groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch")
    )
    classes = land(found.where("rep IS NOT NULL"), "classes")
    lists, ranked = _postings(classes.select("rep", "n", "sketch"), threshold)
    pairs = land(_candidates(lists, threshold), "pairs")

    # Only what is on a list is looked at again.
    sketches = land(classes.select("rep", "sketch").join(lists.select("rep"), "rep", "left_semi"), "listed")
    estimated = land(_estimated(pairs, sketches, least), "estimated")

    # Long lists may still ask for any of their members; fetch texts once for all.
    long = lists.where(F.col("m") > SMALL)
    needed = estimated.select(F.col("a").alias("rep")).unionByName(estimated.select(F.col("b").alias("rep")))
    needed = land(needed.unionByName(long.select("rep")).distinct(), "needed")
    wanted = read.join(needed, read["doc_id"] == needed["rep"]).select("rep", "text")
    held = land(wanted.groupBy("rep").agg(F.first("text").alias("text")), "texts")

    spark = docs.sparkSession
    alone = spark.createDataFrame([], "u bigint, root bigint")
    roots = _settle(estimated, alone, held, shingle, threshold)

    open_lists = _rooted(long.select("value", "rep", "n"), roots, "rep", "root")
    split = open_lists.groupBy("value").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi")
    later = F.expr("slice(values, array_position(values, value) + 1, size(values))")
    dealt = open_lists.join(split.select("value"), "value").join(ranked, "rep").select("value", "rep", "n", "root", F.explode(later).alias("second"))
    dealt = land(dealt, "dealt")
    keys = ["value", "second"]
    split = dealt.groupBy(*keys).agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("size"))
    open_lists = land(dealt.join(split.where("lo != hi").select(*keys, "size"), keys), "open")
    short = open_lists.where(F.col("size") <= SMALL)
    left = _two(short, 1, *keys, "root").withColumnRenamed("root", "c1")
    right = _two(short, 2, *keys, "root").withColumnRenamed("root", "c2")
    rest = _sized(left.join(right, keys).where("c1 < c2"), threshold)
    alike = open_lists.where(F.col("size") > SMALL)
    if not alike.isEmpty():
        members = alike.select("rep", "root").distinct().join(_grouped(alike), "rep").join(held, "rep")
        members = land(members.select("group", "rep", "root", "text"), "members")
        each = land(members.mapInArrow(tidy(_sets(shingle)), "group bigint, rep bigint, root bigint, n bigint, value bigint"), "sets")
        near = _around_centres(each, members, shingle, threshold)
        linked = land(_linked_by_size(near), "linked")
        if not linked.isEmpty():
            roots = _merged(roots, linked)
        rest = rest.unionByName(_by_differences(near, roots, threshold)).unionByName(_within_groups(each, near, threshold))
    rest = rest.distinct().join(pairs, ["a", "b"], "left_anti")
    rest = land(_estimated(rest, sketches, least), "rest")
    roots = _settle(rest, roots, held, shingle, threshold)

    named = _rooted(classes.select("digest", "rep"), roots, "rep", "component_id").select("digest", "component_id")
    out = rows.select("doc_id", "n", "digest").join(named, "digest", "left")
    # An empty set is linked with nothing, not even with another.
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )
