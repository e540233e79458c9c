"""A folder of landed files as a stream of batches."""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from rollbook.streaming.tables import exists, has_batches

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextlib.contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """A stream started inside keeps its state in RocksDB, beyond the executors' heap: a query
    takes the session's settings with it when it starts."""
    held = spark.conf.get(STORE, None)
    spark.conf.set(STORE, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(STORE) if held is None else spark.conf.set(STORE, held)


def landed_files(
    spark: SparkSession, landed: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """The files of the folder as they come, oldest first. ``files_per_batch`` bounds a batch
    when a backlog is worked off."""
    source = spark.readStream.schema(schema)
    if files_per_batch:
        source = source.option("maxFilesPerTrigger", files_per_batch)
    return source.parquet(landed)


def started(
    spark: SparkSession, writer: DataStreamWriter, checkpoint: str, pause: str | None, tables: Sequence[str] = ()
) -> StreamingQuery:
    """Without ``pause``, take what is there and stop. ``tables`` are what the stream writes,
    numbered by its batches: without the checkpoint that numbered them it is not started, as
    it would count from 0 again, and overwrite them or take its new ones for written."""
    if not exists(spark, f"{checkpoint}/metadata"):
        for table in tables:
            if has_batches(spark, table) or exists(spark, f"{table}/_spark_metadata"):
                raise RuntimeError(f"{table} has batches of a stream whose checkpoint {checkpoint} is gone")
    trigger = {"processingTime": pause} if pause else {"availableNow": True}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def follow(
    spark: SparkSession,
    landed: str,
    schema: T.StructType,
    each: Callable[[DataFrame, int], None],
    checkpoint: str,
    pause: str | None,
    files_per_batch: int | None = None,
    tables: Sequence[str] = (),
) -> StreamingQuery:
    """Call ``each`` with every batch of new files, one batch at a time."""
    files = landed_files(spark, landed, schema, files_per_batch)
    return started(spark, files.writeStream.foreachBatch(each), checkpoint, pause, tables)
