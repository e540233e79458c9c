"""Starting tables for the stand-ins, and the shapes results are compared in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rollbook.plans import standins as given
from rollbook.schemas import POOL

def harvested() -> Column:
    """The moment at which the stand-in pages are harvested."""
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


def text_ts(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def widened(pool: DataFrame) -> DataFrame:
    """Pool rows with all columns, those not given left null."""
    before = F.lit("2023-12-31 00:00:00").cast("timestamp")
    filled = {
        f.name: F.lit(None).cast(f.dataType) for f in POOL.fields if f.name not in pool.columns
    }
    return pool.withColumns({**filled, "timestamp": before}).select(*POOL.fieldNames())


def listing_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as pooled endpoints in the address range of the listing pages."""
    key = F.col("c_custkey")
    return given.table(spark, sf_dir, "customer").select(
        F.concat(
            F.lit("10.0."),
            F.expr("c_custkey div 250").cast("string"),
            F.lit("."),
            (key % 250).cast("string"),
        ).alias("ip"),
        (8000 + key % 100).cast("string").alias("port"),
    )


def seeded_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    return widened(listing_pool(spark, sf_dir))


def stacked(pool: DataFrame, now: DataFrame, history: DataFrame) -> DataFrame:
    """The three tables in one shape."""
    none = F.lit(None).cast("string")

    def shaped(df, name, id_, ip, tm):
        return df.select(
            F.lit(name).alias("tbl"), F.col(id_).alias("id"), ip.alias("ip"), "anonymous", tm.alias("tm")
        )

    ip = F.col("ip")
    return (
        shaped(pool, "pool", "_id", ip, none)
        .unionByName(shaped(now, "now", "url", none, text_ts(F.col("tm"))))
        .unionByName(shaped(history, "history", "_id", ip, none))
    )
