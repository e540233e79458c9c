"""Column helpers: classes, schemes, endpoint URLs, trimming, probe rules."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# Label fragments of the four privacy classes, first match wins.
ELITE_MARKS = ("高匿", "普匿")
COMMON_MARK = "普通"
TRANSPARENT_MARK = "透明"

# Listing kinds that count as domestic on the site with foreign kinds.
DOMESTIC_KINDS = ("1", "2")

# Targets a probe asks for through the endpoint.
DOMESTIC_TARGET = "http://www.baidu.com"
FOREIGN_TARGET = "https://www.google.com"

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def classify(label: Column) -> Column:
    """privacy class A, C, T or N by substring."""
    elite = reduce(lambda a, b: a | b, [label.contains(mark) for mark in ELITE_MARKS])
    return (
        F.when(elite, "A")
        .when(label.contains(COMMON_MARK), "C")
        .when(label.contains(TRANSPARENT_MARK), "T")
        .otherwise("N")
    )


def classify_foreign(label: Column, kind: Column) -> Column:
    """as :func:`classify`, with a ``W`` in front for every non-domestic kind."""
    return F.concat(F.when(kind.isin(*DOMESTIC_KINDS), "").otherwise("W"), classify(label))


def strip_ws(text: Column) -> Column:
    """strip all Unicode whitespace at both ends (``trim`` removes spaces only)."""
    return F.btrim(text, F.lit(WHITESPACE))


def endpoint_url(http: Column, ip: Column, port: Column) -> Column:
    """``scheme://ip:port`` with the scheme in lower case."""
    return F.concat(F.lower(http), F.lit("://"), ip, F.lit(":"), port)


def eligible(anonymous: Column) -> Column:
    """Rows that are swept and probed. Null for a null class, which filters and
    ``when`` take as false; plain comparisons are what a scan can evaluate itself."""
    return (anonymous == "A") | anonymous.startswith("W")


def probe_route(anonymous: Column) -> Column:
    """class A asks for the domestic target, all others for the foreign one."""
    return F.when(anonymous.eqNullSafe("A"), DOMESTIC_TARGET).otherwise(FOREIGN_TARGET)


def outcome(err_kind: Column) -> Column:
    """0 for an HTTP-client error, 1 for any answer, null for any other failure."""
    return F.when(err_kind == "http_error", 0).when(err_kind.isNull(), 1)


def ts14(ts: Column) -> Column:
    """``yyyyMMddHHmmss`` text."""
    return F.date_format(ts, "yyyyMMddHHmmss")


def keyed_join(
    left: DataFrame,
    right: DataFrame,
    names: Sequence[str],
    how: str,
    nonnull: Sequence[str] = (),
) -> DataFrame:
    """Join on ``names``, in which a missing value equals a missing value.

    Columns in ``nonnull`` are join keys too and compared plainly. The right side's
    keys do not appear in the result.
    """
    ours = {n: f"_right_{n}" for n in (*names, *nonnull)}
    terms = [F.col(n).eqNullSafe(F.col(ours[n])) for n in names]
    terms += [F.col(n) == F.col(ours[n]) for n in nonnull]
    joined = left.join(right.withColumnsRenamed(ours), reduce(lambda a, b: a & b, terms), how)
    return joined.drop(*ours.values())
