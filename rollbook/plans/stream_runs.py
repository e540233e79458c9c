"""Streams over the given tables: each table lands slice by slice in arrival order.

The stream is started anew for every slice and goes on from its checkpoint, so
what is read at the end has crossed batches and restarts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollbook.plans import standins as given
from rollbook.plans import tables
from rollbook.schemas import OUTCOME, PAGES, RECORD
from rollbook.session import fresh_dir, settle
from rollbook.streaming.fold import fold_stream, now_stream
from rollbook.streaming.harvest import harvest_stream
from rollbook.streaming.ledger import Ledger
from rollbook.streaming.membership import ledger_stream, read_admissions
from rollbook.streaming.sweep import sweep_cycle

SLICES = 3


def _land_and_run(df: DataFrame, order: str, start: Callable, root: str) -> None:
    """Cut ``df`` into slices of its arrival order, land each and run the streams."""
    table = settle(df, "arrivals")
    last = table.agg(F.max(order)).first()[0]
    number = F.expr(f"{order} * {SLICES} div {(last or 0) + 1}")
    for i in range(SLICES):
        table.where(number == i).write.mode("append").parquet(f"{root}/landed")
        for query in start(f"{root}/landed"):
            query.awaitTermination()


def _harvested(spark: SparkSession, sf_dir: str) -> Ledger:
    root = fresh_dir(spark, "harvest")
    ledger = Ledger(spark, root)
    ledger.seed(tables.seeded_pool(spark, sf_dir), "pool")
    pages = given.listing_pages(spark, sf_dir).select(*PAGES.fieldNames())

    def start(landed):
        cores = spark.sparkContext.defaultParallelism
        return [harvest_stream(spark, landed, root, as_of=tables.harvested(), pause=None, partitions=cores)]

    _land_and_run(pages, "page_seq", start, root)
    return ledger


def harvest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _harvested(spark, sf_dir).crawdetail()


def harvest_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _harvested(spark, sf_dir).pool()


def readmitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pool after all listing pages, all deaths among their keys, and all pages again.

    Deaths are stamped years before or after the harvest's clock, by turns: what counts is
    that they arrive between the two harvests.
    """
    root = fresh_dir(spark, "readmission")
    ledger = Ledger(spark, root)
    pages = settle(given.listing_pages(spark, sf_dir).select(*PAGES.fieldNames()), "pages")
    rows = given.listing_rows(spark, sf_dir)
    early = F.col("event_id") % 2 == 0
    record = {f.name: F.lit(None).cast(f.dataType) for f in RECORD.fields}
    record |= {"_id": F.col("event_id").cast("string"), "ip": F.col("ip"), "port": F.col("port")}
    deaths = rows.where("event_type = 'error'").select(
        F.lit(0).alias("result"),
        F.lit("http://gone").alias("purl"),
        F.struct(*[c.alias(n) for n, c in record.items()]).alias("record"),
        F.when(early, F.lit("2001-01-01 00:00:00")).otherwise(F.lit("2049-01-01 00:00:00")).cast("timestamp").alias("order_ts"),
        F.col("event_id").alias("seq"),
    )
    again = pages.withColumn("page_seq", F.col("page_seq") + F.lit(1_000_000_000))
    for batch in (pages, deaths, again):
        name = "outcomes" if batch is deaths else "landed"
        batch.write.mode("append").parquet(f"{root}/{name}")
        stream = (
            fold_stream(spark, f"{root}/{name}", root, pause=None)
            if batch is deaths
            else harvest_stream(
                spark, f"{root}/{name}", root, as_of=tables.harvested(), pause=None,
                partitions=spark.sparkContext.defaultParallelism,
            )
        )
        stream.awaitTermination()
    return ledger.pool().select("_id", "ip", "port")


def _folded(spark: SparkSession, sf_dir: str) -> Ledger:
    root = fresh_dir(spark, "fold")
    ledger = Ledger(spark, root)
    pool = tables.widened(given.pool(spark, sf_dir))
    ledger.seed(pool, "pool")
    before = {"result": F.lit(1), "seq": F.lit(None).cast("bigint")}
    ledger.seed(given.now(spark, sf_dir).withColumns(before), "now")
    ledger.seed(given.history(spark, sf_dir), "history")

    def start(landed):
        return [fold_stream(spark, landed, root, pause=None), now_stream(spark, landed, root, pause=None)]

    _land_and_run(given.outcomes(spark, sf_dir).select(*OUTCOME.fieldNames()), "seq", start, root)
    return ledger


def fold_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = _folded(spark, sf_dir)
    return tables.stacked(ledger.pool(), ledger.now(), ledger.history())


def live_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _folded(spark, sf_dir).now()


def swept_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What two sweeps dispatch, the second one run again after it has finished."""
    root = fresh_dir(spark, "sweep")
    ledger = Ledger(spark, root)
    ledger.seed(tables.widened(given.pool(spark, sf_dir)), "pool")
    for number in (0, 1, 1):
        sweep_cycle(spark, root, number)
    return ledger.dispatched()


def ledger_admissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = fresh_dir(spark, "ledger")
    events = given.log(spark, sf_dir)

    def start(landed):
        return [ledger_stream(spark, landed, root, events.schema, ["ip"])]

    _land_and_run(events, "seq", start, root)
    return read_admissions(spark, root, events.schema)
