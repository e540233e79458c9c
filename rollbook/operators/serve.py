"""The newest live endpoints, and one for each request."""

from __future__ import annotations

from collections.abc import Mapping
from types import MappingProxyType
from typing import Any

from pyspark.sql import Column, DataFrame, Window, functions as F

from rollbook.functions.predicates import predicate

# Default filter, list length, and the largest draw.
DEFAULT_WHERE = MappingProxyType({"anonymous": "A"})
TOP_N = 30
MAX_DRAW = 100


def find(now: DataFrame, where: Mapping[str, Any]) -> DataFrame:
    return now.where(predicate(now, where))


def freshest(now: DataFrame, n: int, where: Mapping[str, Any] = DEFAULT_WHERE) -> DataFrame:
    """Top ``n`` by recency, ties by url."""
    return find(now, where).orderBy(F.desc("tm"), "url").limit(n)


def random_draw(seed: int | None = None) -> Column:
    """A draw in 0..100 for each request."""
    return F.floor(F.rand(seed) * (MAX_DRAW + 1))


def assign(
    requests: DataFrame,
    now: DataFrame,
    draw: Column,
    n: int = TOP_N,
    modulus: int | None = None,
    where: Mapping[str, Any] = DEFAULT_WHERE,
) -> DataFrame:
    """Adds the ``url`` of the endpoint at ``draw % size`` of the top ``n``.

    ``draw`` is a column of integers in 0..100. With ``modulus`` the divisor is fixed;
    an index past the end of the list, or an empty list, assigns null. The top list
    is turned into one row per possible draw, so the broadcast side has at most 101
    rows whatever the size of ``now``. No draw reaches past the first 101 of the list,
    so a longer one is not made.
    """
    whole = Window.partitionBy(F.lit(0))
    ranked = freshest(now, min(n, MAX_DRAW + 1), where).select(
        "url",
        (F.row_number().over(whole.orderBy(F.desc("tm"), "url")) - 1).alias("idx"),
        F.count(F.lit(1)).over(whole).alias("size"),
    )
    divisor = F.col("size") if modulus is None else F.lit(modulus)
    by_draw = ranked.select(
        "url",
        F.explode(F.sequence(F.lit(0), F.lit(MAX_DRAW))).alias("draw"),
        "idx",
        divisor.alias("divisor"),
    ).where(F.col("draw") % F.col("divisor") == F.col("idx")).select("draw", "url")
    drawn = requests.withColumn("draw", draw.cast("int"))
    return drawn.join(F.broadcast(by_draw), "draw", "left")
