"""Probe results and their effect on pool, now and history.

Outcomes carry ``seq``, the unique number of their arrival: arrival order rules.
Each table after a batch is a keyed reduction, never a replay of single results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rollbook.functions.scalars import endpoint_url, keyed_join, outcome
from rollbook.operators.ingest import KEYS
from rollbook.operators.sweep import DISPATCHED


def classify_probes(probes: DataFrame) -> DataFrame:
    """adds ``result``; failures outside the HTTP client leave no outcome."""
    return probes.withColumn("result", outcome(F.col("err_kind"))).where(F.col("result").isNotNull())


def attach_records(outcomes: DataFrame, dispatched: DataFrame) -> DataFrame:
    """Gives outcomes that landed as ``record_id`` their record and endpoint URL.

    ``dispatched`` is what was sent to be probed. An outcome of anything else has no
    record to act on: see :func:`unmatched`."""
    records = dispatched.select(
        F.col("_id").alias("record_id"),
        F.struct(*DISPATCHED).alias("record"),
        endpoint_url(F.col("http"), F.col("ip"), F.col("port")).alias("purl"),
    )
    return outcomes.join(records, "record_id").drop("record_id")


def unmatched(outcomes: DataFrame, dispatched: DataFrame) -> DataFrame:
    """The outcomes that :func:`attach_records` leaves out, to be reported."""
    sent = dispatched.select(F.col("_id").alias("record_id"))
    return outcomes.join(sent, "record_id", "left_anti")


def dead(outcomes: DataFrame) -> DataFrame:
    """Results below one."""
    return outcomes.where(F.col("result") < 1)


def alive(outcomes: DataFrame) -> DataFrame:
    return outcomes.where(F.col("result") >= 1)


def dead_keys(outcomes: DataFrame) -> DataFrame:
    """Each key with a dead outcome once."""
    return dead(outcomes).select(*[F.col(f"record.{k}").alias(k) for k in KEYS]).distinct()


def pool_without(pool: DataFrame, keys: DataFrame) -> DataFrame:
    """Removes *every* pool row of the given keys, whatever its scheme or class."""
    return keyed_join(pool, keys, KEYS, "left_anti")


def now_without(now: DataFrame, outcomes: DataFrame) -> DataFrame:
    """K7: removes the exact URLs with a dead outcome."""
    urls = dead(outcomes).select(F.col("purl").alias("url")).distinct()
    return now.join(urls, "url", "left_anti")


def outcomes_by_url(outcomes: DataFrame) -> DataFrame:
    return outcomes.select(
        F.col("purl").alias("url"),
        "seq",
        "result",
        F.col("order_ts").alias("tm"),
        F.col("record.anonymous").alias("anonymous"),
    )


def last_by_url(outcomes: DataFrame) -> DataFrame:
    """The last outcome of each URL: url, seq, result, tm, anonymous."""
    return latest(outcomes_by_url(outcomes), "url", "seq")


def now_after(now: DataFrame, outcomes: DataFrame) -> DataFrame:
    """A URL is present iff its last outcome is alive; the whole row is replaced."""
    old = now.select(
        "url", F.lit(None).cast("bigint").alias("seq"), F.lit(1).alias("result"), "tm", "anonymous"
    )
    last = latest(old.unionByName(outcomes_by_url(outcomes)), "url", "seq")
    return alive(last).select("url", "tm", "anonymous")


def upsert_now(now: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The upsert alone, as if no outcome were dead."""
    return now_after(now, alive(outcomes))


def _dead_records(outcomes: DataFrame) -> DataFrame:
    return dead(outcomes).select("record.*", "seq")


def dead_records(outcomes: DataFrame) -> DataFrame:
    """K6: the record of the last dead outcome of each ``_id``."""
    return latest(_dead_records(outcomes), "_id", "seq").drop("seq")


def history_after(history: DataFrame, outcomes: DataFrame) -> DataFrame:
    """K6: insert or replace by ``_id``."""
    old = history.withColumn("seq", F.lit(None).cast("bigint"))
    return latest(old.unionByName(_dead_records(outcomes)), "_id", "seq").drop("seq")


def fold(
    pool: DataFrame, now: DataFrame, history: DataFrame, outcomes: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three tables after a batch of outcomes in any number.

    The outcomes are read three times: settle them first if they come from a join.
    """
    return (
        pool_without(pool, dead_keys(outcomes)),
        now_after(now, outcomes),
        history_after(history, outcomes),
    )


def latest(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The row of each key with the greatest ``order``; a null order is the oldest.

    An aggregate, so every task sends at most one row per key whatever its share.
    """
    rest = [c for c in rows.columns if c not in (key, order)]
    return (
        rows.groupBy(key)
        .agg(F.max(F.struct(F.col(order), *rest)).alias("last"))
        .select(key, f"last.{order}", *[f"last.{c}" for c in rest])
        .select(*rows.columns)
    )
