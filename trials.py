"""Larger trials of single operators on rows that Spark makes: ``python trials.py [ROWS]``.

A third of the rows have one key. Each trial is timed once, its result thrown away.
"""

from __future__ import annotations

import os
import sys
import time

from pyspark.sql import DataFrame, functions as F

from rollbook.operators import ingest, outcomes, replay
from rollbook.session import build_session

ROWS = int(sys.argv[1]) if len(sys.argv) > 1 else 12_000_000
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))


def made(spark) -> DataFrame:
    """Sightings: a key of half a million, a third of them the same, 100 to a page."""
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.pmod(F.xxhash64("id"), F.lit(500_000)))
    return spark.range(0, ROWS, 1, 4 * int(CPUS)).select(
        key.cast("string").alias("ip"),
        F.lit("80").alias("port"),
        F.expr("id div 100").alias("page_seq"),
        F.col("id").alias("seq"),
        (F.col("id") % 11 == 0).alias("dead"),
    )


def latest_hashed(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The greatest order by key as a hash aggregate, joined back."""
    top = rows.groupBy(key).agg(F.max(order).alias(order))
    return rows.join(top, [key, order])


def main() -> None:
    spark = build_session(
        f"local[{CPUS}]", "rollbook-trials",
        **{"spark.sql.shuffle.partitions": str(4 * int(CPUS)), "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    rows = made(spark)
    pool = spark.range(500_000).select(F.col("id").cast("string").alias("ip"), F.lit("81").alias("port"))
    pages = rows.select("page_seq").distinct()
    trials = {
        "admit": lambda: ingest.admit(rows, pool),
        "page accounts": lambda: ingest.accounting(rows, pool, pages),
        "admissions": lambda: replay.admissions(rows, ["ip", "port"]),
        "latest by key, sorted": lambda: outcomes.latest(rows, "ip", "seq"),
        "latest by key, hashed and joined": lambda: latest_hashed(rows, "ip", "seq"),
        "pool_without": lambda: outcomes.pool_without(rows, pool.select("ip", "port")),
    }
    for name, make in trials.items():
        start = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        print(f"{name}: {time.perf_counter() - start:.1f} s", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
