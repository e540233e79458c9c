"""Probe outcomes as they land -> deaths, history, live URLs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from rollbook.operators.outcomes import dead_keys, dead_records, outcomes_by_url
from rollbook.schemas import OUTCOME
from rollbook.streaming.follow import follow, landed_files, started, state_on_disk
from rollbook.streaming.ledger import Ledger

# Fixed value: pause between two rounds of outcomes.
FOLD_PAUSE = "30 seconds"


def fold_batch(outcomes: DataFrame, number: int, root: str) -> None:
    """One batch of outcomes: appends its dead records and its deaths, reduced by key.

    A death removes the rows that are in the pool when it arrives; it says so by the
    pool's last round, whatever any clock shows.
    """
    ledger = Ledger(outcomes.sparkSession, root)
    upto = F.lit(ledger.death_horizon(number)).cast("bigint")
    ledger.add(dead_records(outcomes), "history", number)
    ledger.add(dead_keys(outcomes).withColumn("upto", upto), "deaths", number)


def fold_stream(
    spark: SparkSession,
    landed: str,
    root: str,
    pause: str | None = FOLD_PAUSE,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Pool and history. Follows the folder ``landed``; the checkpoint lies with the tables
    under ``root``."""

    def each(batch: DataFrame, number: int) -> None:
        fold_batch(batch, number, root)

    tables = [f"{root}/{name}" for name in ("history", "deaths")]
    return follow(spark, landed, OUTCOME, each, f"{root}/_fold", pause, files_per_batch, tables)


def now_stream(
    spark: SparkSession,
    landed: str,
    root: str,
    pause: str | None = FOLD_PAUSE,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Live URLs: the last outcome of each URL is the state of a streaming aggregate, one row
    a URL; each batch writes the URLs whose last outcome changed, with their new one."""
    last = (
        outcomes_by_url(landed_files(spark, landed, OUTCOME, files_per_batch))
        .groupBy("url")
        .agg(F.max(F.struct("seq", "result", "tm", "anonymous")).alias("last"))
    )

    def each(changed: DataFrame, number: int) -> None:
        Ledger(spark, root).add(changed.select("url", "last.*"), "now", number)

    writer = last.writeStream.outputMode("update").foreachBatch(each)
    with state_on_disk(spark):
        return started(spark, writer, f"{root}/_now", pause, [f"{root}/now"])
