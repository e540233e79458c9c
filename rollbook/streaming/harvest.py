"""Listing pages as they land -> pool, page accounting, page errors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from rollbook.functions.scalars import ts14
from rollbook.operators.extract import error_log, extract, split, unnest
from rollbook.operators.ingest import PAGE, accounting_after, admit, pool_rows
from rollbook.schemas import PAGES, POOL
from rollbook.sources.responses import page_files
from rollbook.sources.sites import SITES, Site
from rollbook.streaming.follow import follow, started
from rollbook.streaming.ledger import ROUNDS, Ledger

# Fixed value: pause between two harvest rounds.
HARVEST_PAUSE = "10 minutes"


def numbered_once(items: DataFrame) -> DataFrame:
    """Pages without a number, or that share one, fail: rows and accounts are told
    apart by it."""
    shared = items.groupBy(PAGE).agg(F.count(F.lit(1)).alias("pages")).where("pages > 1")
    joined = items.join(shared, PAGE, "left")
    problem = F.when(F.col(PAGE).isNull(), "no page number").when(
        F.col("pages").isNotNull(), F.concat(F.lit("page number shared by "), "pages", F.lit(" pages"))
    )
    return joined.withColumns({
        "reslist": F.when(problem.isNull(), F.col("reslist")),
        "error": F.coalesce(problem, "error"),
    }).select(*items.columns)


def harvest_batch(
    pages: DataFrame, number: int, root: str, sites: Sequence[Site], as_of: Column, partitions: int | None = None
) -> None:
    """One batch of pages.

    The parsed pages are written once and feed all three tables; the page counts come
    from the stored rows, so admission is computed once. What the round did is observed on
    the way and recorded last: with that, its rows are in the pool.
    """
    spark = pages.sparkSession
    ledger = Ledger(spark, root)
    parsed, stored = Observation(), Observation()
    found = numbered_once(extract(pages, sites, partitions)).observe(
        parsed,
        F.count(F.lit(1)).alias("pages"),
        F.count("error").alias("failures"),
        F.sum(F.when(F.col("error").isNull(), F.size("reslist"))).alias("items"),
    )
    ledger.add(found, "items", number)
    items = ledger.items(number)
    whole, _ = split(items)
    rows = unnest(items)
    known = ledger.known(rows, before=number)
    row_id = F.concat_ws("-", PAGE, "row_no")
    admitted = pool_rows(admit(rows, known), row_id, as_of).select(*POOL.fieldNames(), PAGE)
    ledger.add(admitted.observe(stored, F.count(F.lit(1)).alias("added")), "pool", number)
    seen = whole.select("url", "kinddesc", PAGE, F.size("reslist").cast("bigint").alias("seen"))
    detail = accounting_after(seen, ledger.admitted(number)).drop(PAGE).withColumn("timestamp", ts14(as_of))
    ledger.add(detail, "crawdetail", number)
    ledger.add(error_log(items, as_of), "crawlog", number)
    told = {**parsed.get, **stored.get}
    counts = [int(told.get(name) or 0) for name in ROUNDS.fieldNames()]
    ledger.add(spark.createDataFrame([counts], ROUNDS), "rounds", number)


def harvest_stream(
    spark: SparkSession,
    landed: str,
    root: str,
    sites: Sequence[Site] = SITES,
    as_of: Column | None = None,
    pause: str | None = HARVEST_PAUSE,
    files_per_batch: int | None = None,
    partitions: int | None = None,
    raw: bool = False,
) -> StreamingQuery:
    """Follow the folder ``landed``: tables of pages, or with ``raw`` the page files of
    :func:`~rollbook.sources.responses.page_files`. The checkpoint lies with the tables under
    ``root``.
    ``partitions``: see :func:`~rollbook.operators.extract.extract`."""
    stamp = F.current_timestamp() if as_of is None else as_of

    def each(batch: DataFrame, number: int) -> None:
        harvest_batch(batch, number, root, sites, stamp, partitions)

    tables = [f"{root}/{name}" for name in ("items", "crawdetail", "crawlog", "rounds")]
    if raw:
        writer = page_files(spark, landed, sites, stream=True).writeStream.foreachBatch(each)
        return started(spark, writer, f"{root}/_harvest", pause, tables)
    return follow(spark, landed, PAGES, each, f"{root}/_harvest", pause, files_per_batch, tables)
