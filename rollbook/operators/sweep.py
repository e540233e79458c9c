"""The sweep counter and the dispatch list."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rollbook.functions.scalars import eligible
from rollbook.operators.ingest import scan_eligible

DISPATCHED = ("_id", "ip", "port", "anonymous", "status", "http", "kinddesc")


def status_levels(pool: DataFrame) -> DataFrame:
    """Distinct counters of eligible rows, highest first."""
    return scan_eligible(pool).select("status").distinct().orderBy(F.desc("status"))


def sweep(pool: DataFrame) -> DataFrame:
    """One cycle: every eligible counter rises by one.

    Working level by level from the highest down, each eligible row is raised
    exactly once, which is one projection over the snapshot.
    """
    raised = F.when(eligible(F.col("anonymous")), F.col("status") + 1).otherwise(F.col("status"))
    return pool.withColumn("status", raised)


def dispatch(swept: DataFrame) -> DataFrame:
    """The rows to probe, highest counter first.

    The id in the sort key lets range partitioning cut through a level that holds
    a large share of the rows.
    """
    return scan_eligible(swept).select(*DISPATCHED).orderBy(F.desc("status"), "_id")


def dispatch_count(swept: DataFrame) -> DataFrame:
    """A4: length of the dispatch list per level."""
    return scan_eligible(swept).groupBy("status").agg(F.count(F.lit(1)).alias("n"))
