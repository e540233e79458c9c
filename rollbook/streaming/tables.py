"""Tables that streams append to: plain Parquet, partitioned by the batch that wrote them.

The rows of a batch are its partition, written by dynamic partition overwrite: a batch that
is repeated after a failure replaces its own rows by the same rows and touches no others. So
a batch may read what older batches wrote, never its own number or a later one.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

BATCH = "batch"
#: What a table held before its first batch.
SEED = -1


def _absent(e: AnalysisException) -> bool:
    return e.getCondition() == "PATH_NOT_FOUND"


def exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path)
    except AnalysisException as e:
        if not _absent(e):
            raise
        return False
    return True


def write_batch(df: DataFrame, path: str, number: int, *by: str) -> None:
    """The rows of batch ``number``, also partitioned by the columns ``by``."""
    rows = df.withColumn(BATCH, F.lit(number).cast("bigint"))
    if by:
        rows = rows.repartition(*by)  # one file for each of the batch's partitions
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by, BATCH).parquet(path)


def read_batches(spark: SparkSession, path: str, schema: T.StructType, *by: str) -> DataFrame:
    """All rows with the number of their ``batch``; none where nothing was written yet."""
    full = T.StructType([*schema.fields, *[T.StructField(name, T.LongType()) for name in (*by, BATCH)]])
    try:
        return spark.read.schema(full).parquet(path)
    except AnalysisException as e:
        if not _absent(e):
            raise
    # A filter that is false at planning time lets the optimizer drop joins with it.
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in full.fields]
    return spark.range(1).where(F.lit(False)).select(*nulls)


def has_batches(spark: SparkSession, path: str) -> bool:
    """Whether a stream has written to the table."""
    return not read_batches(spark, path, T.StructType([])).where(F.col(BATCH) > SEED).isEmpty()
