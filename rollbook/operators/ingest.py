"""Which sightings enter the pool, and the count per page.

A key is admitted by the first page that shows it, unless the pool holds it
already; all sightings of the key on that one page enter, duplicates included.
Sightings without a page number share one page, which comes after all numbered ones.
Sightings are read more than once: settle them first if they are costly to make.
"""

from __future__ import annotations

from collections.abc import Sequence
from types import MappingProxyType

from pyspark.sql import Column, DataFrame, functions as F

from rollbook.functions.predicates import predicate
from rollbook.functions.scalars import keyed_join

KEYS = ("ip", "port")
PAGE = "page_seq"


def _winners(counted: DataFrame, pool: DataFrame, keys: Sequence[str], page: str) -> DataFrame:
    """Unpooled keys with their first page and the rows (``n``) it shows.

    Sightings and pool keys meet in one aggregate: both are combined on the map
    side, so a key that holds a third of all rows arrives as one row per task.
    """
    pooled = pool.select(
        *keys,
        F.lit(None).cast(counted.schema[page].dataType).alias(page),
        F.lit(None).cast("bigint").alias("n"),
        F.lit(True).alias("pooled"),
    )
    return (
        counted.select(*keys, page, "n", F.lit(False).alias("pooled"))
        .unionByName(pooled)
        .groupBy(*keys)
        .agg(
            # Both skip null pages; a key seen on none but the null page has that one's rows.
            F.coalesce(F.min_by("n", page), F.sum(F.when(F.col(page).isNull(), F.col("n")))).alias("n"),
            F.min(page).alias(page),
            F.max("pooled").alias("pooled"),
        )
        .where(~F.col("pooled"))
        .drop("pooled")
    )


def _first_pages(
    sightings: DataFrame, pool: DataFrame, keys: Sequence[str], page: str
) -> DataFrame:
    each = sightings.select(*keys, page, F.lit(1).cast("bigint").alias("n"))
    return _winners(each, pool, keys, page).drop("n")


def flag_new(
    sightings: DataFrame, pool: DataFrame, keys: Sequence[str] = KEYS, page: str = PAGE
) -> DataFrame:
    """Every sighting with ``is_new`` (J1 and J2 in one pass).

    The join is on key *and* page, which spreads a hot key over its pages.
    """
    first = _first_pages(sightings, pool, keys, page).withColumn("is_new", F.lit(True))
    joined = keyed_join(sightings, first, [*keys, page], "left")
    return joined.withColumn("is_new", F.coalesce("is_new", F.lit(False)))


def admit(
    sightings: DataFrame, pool: DataFrame, keys: Sequence[str] = KEYS, page: str = PAGE
) -> DataFrame:
    """The admitted sightings only."""
    first = _first_pages(sightings, pool, keys, page)
    return keyed_join(sightings, first, [*keys, page], "left_semi")


def existing(
    sightings: DataFrame, pool: DataFrame, keys: Sequence[str] = KEYS, page: str = PAGE
) -> DataFrame:
    """The sightings whose key was known before their page."""
    return flag_new(sightings, pool, keys, page).where(~F.col("is_new")).drop("is_new")


def accounting(
    sightings: DataFrame,
    pool: DataFrame,
    pages: DataFrame,
    keys: Sequence[str] = KEYS,
    page: str = PAGE,
) -> DataFrame:
    """A1: ``total``, ``addcount``, ``existcount`` for each row of ``pages``.

    ``pages`` has one row per whole page, empty pages included. ``total`` counts new
    rows only, so it equals ``addcount``. No sighting is joined: rows are counted
    per key and page, then per key, then per page.
    """
    counted = sightings.groupBy(*keys, page).agg(F.count(F.lit(1)).alias("n"))
    zero = F.lit(0).cast("bigint")
    seen = counted.select(page, F.col("n").alias("seen"), zero.alias("added"))
    added = _winners(counted, pool, keys, page).select(page, zero.alias("seen"), F.col("n").alias("added"))
    sums = (
        seen.unionByName(added)
        .groupBy(page)
        .agg(F.sum("seen").alias("seen"), F.sum("added").alias("added"))
    )
    return _counts(keyed_join(pages, sums, [page], "left"), pages.columns)


def accounting_after(pages: DataFrame, admitted: DataFrame, page: str = PAGE) -> DataFrame:
    """A1 once the admitted rows are stored: ``pages`` also has its row count ``seen``."""
    added = admitted.groupBy(page).agg(F.count(F.lit(1)).alias("added"))
    return _counts(pages.join(added, page, "left"), [c for c in pages.columns if c != "seen"])


def _counts(pages: DataFrame, kept: Sequence[str]) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    new = F.coalesce("added", zero)
    return pages.select(
        *kept,
        new.alias("total"),
        new.alias("addcount"),
        (F.coalesce("seen", zero) - new).alias("existcount"),
    )


def key_counts(pool: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """A2: rows per key."""
    return pool.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def pool_rows(admitted: DataFrame, row_id: Column, as_of: Column) -> DataFrame:
    """Admitted sightings as pool rows."""
    return admitted.withColumns({
        "_id": row_id,
        "status": F.lit(0),
        "timestamp": as_of,
        "rmrk": F.lit(""),
    })


# Fixed value: the filter document of a sweep.
ELIGIBLE = MappingProxyType({"$or": [{"anonymous": "A"}, {"anonymous": {"$regex": "^W"}}]})


def scan_eligible(pool: DataFrame) -> DataFrame:
    """The rows a sweep looks at."""
    return pool.where(predicate(pool, ELIGIBLE))
