"""Sweeps of the pool -> raised counters and the list of rows to probe."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from rollbook.operators.sweep import dispatch
from rollbook.streaming.ledger import Ledger

# Fixed value: pause between two sweeps.
SWEEP_PAUSE = "30 seconds"


def sweep_cycle(spark: SparkSession, root: str, number: int) -> None:
    """Sweep ``number`` (0, 1, 2, ...), safe to repeat.

    Rows admitted while it runs are swept next time.
    """
    ledger = Ledger(spark, root)
    ledger.add(dispatch(ledger.sweep(number)), "dispatch", number)


def sweep_stream(spark: SparkSession, root: str, pause: str = SWEEP_PAUSE) -> StreamingQuery:
    """A sweep every ``pause``: a clock is the source, its batch number the sweep's."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return (
        ticks.writeStream.foreachBatch(lambda _, number: sweep_cycle(spark, root, number))
        .option("checkpointLocation", f"{root}/_sweep")
        .trigger(processingTime=pause)
        .start()
    )
