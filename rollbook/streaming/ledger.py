"""The ledger's tables as they stand: keyed reductions over what the batches appended.

Order among the tables is arrival order, told by batch numbers and by no clock. A harvest
batch is in the pool once its round is recorded, which is the last thing it does. A death
records the last round there was when it came, and removes its key's rows of rounds up to
that one. A sweep records which rounds it is the first to see; a row's counter is what it
came with plus the sweeps since.

Rows with keys (pool, deaths) lie in ``SLOTS`` partitions by a hash of the key. A lookup of a
batch's keys reads the slots that these fall into, and drops other keys within the scan by a
bitmap of the batch's key hashes, a Bloom filter with one hash function; both are bounded,
whatever the batch and the table hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from rollbook.functions.scalars import eligible, keyed_join
from rollbook.operators.ingest import KEYS, PAGE
from rollbook.operators.outcomes import alive, latest
from rollbook.schemas import CRAWDETAIL, CRAWLOG, HISTORY, ITEM, NOW, POOL, RECORD
from rollbook.streaming.tables import BATCH, SEED, read_batches, write_batch

#: Partitions by key, and bits of a batch's bitmap.
SLOTS, BITS = 16, 1 << 15
SLOT = "slot"

_KEYS = [POOL[k] for k in KEYS]
#: ``upto``: the last round when the death came.
DEATHS = T.StructType([*_KEYS, T.StructField("upto", T.LongType())])
#: By sweep: the rounds it is the first to see; null says only that it ran.
SEEN = T.StructType([T.StructField("round", T.LongType())])
#: By harvest batch, when all its tables are written.
ROUNDS = T.StructType([T.StructField(n, T.LongType()) for n in ("pages", "failures", "items", "added")])
NOW_LOG = T.StructType([*NOW.fields, T.StructField("result", T.IntegerType()), T.StructField("seq", T.LongType())])


def key_bit() -> Column:
    """The place of a row's key in a bitmap; rows with equal keys (nulls too) share it."""
    return F.pmod(F.xxhash64(*KEYS), F.lit(BITS))


def slotted(rows: DataFrame) -> DataFrame:
    return rows.withColumn(SLOT, F.floor(key_bit() / (BITS // SLOTS)))


def near_keys(batch: DataFrame) -> Column:
    """For a slotted table: whether a row may have a key of ``batch``. Others that share a bit
    with one pass too."""
    bits = {row[0] for row in batch.select(key_bit().alias("bit")).distinct().collect()}  # at most BITS
    words = [0] * (BITS // 64)
    for bit in bits:
        words[bit // 64] |= 1 << (bit % 64)
    # Sixty-four bits a number, as a signed one; the array is one literal of the plan.
    half = 1 << 62
    signed = (f"({w % (2 * half)}L - {half}L - {half}L)" if w >> 63 else f"{w}L" for w in words)
    mask = F.expr(f"array({', '.join(signed)})")
    here = F.bit_get(F.element_at(mask, (F.floor(key_bit() / 64) + 1).cast("int")), (key_bit() % 64).cast("int"))
    slots = sorted({bit // (BITS // SLOTS) for bit in bits})
    return F.col(SLOT).isin(slots) & (here == 1)


def living(rows: DataFrame, deaths: DataFrame) -> DataFrame:
    """Pool rows that came after the last death of their key."""
    last = deaths.groupBy(*KEYS).agg(F.max("upto").alias("upto"))
    joined = keyed_join(rows, last, KEYS, "left")
    return joined.where(F.col("upto").isNull() | (F.col(BATCH) > F.col("upto"))).drop("upto")


class Ledger:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _read(self, name: str, schema: T.StructType, *by: str) -> DataFrame:
        return read_batches(self.spark, self.path(name), schema, *by)

    def add(self, rows: DataFrame, name: str, number: int) -> None:
        """Batch ``number`` of a table."""
        if name in ("pool", "deaths"):
            write_batch(slotted(rows), self.path(name), number, SLOT)
        else:
            write_batch(rows, self.path(name), number)

    def seed(self, rows: DataFrame, name: str) -> None:
        """What a table holds before the streams begin."""
        self.add(rows, name, SEED)

    def items(self, number: int) -> DataFrame:
        """The parsed pages of a harvest batch."""
        return self._read("items", ITEM).where(F.col(BATCH) == number).drop(BATCH)

    def admitted(self, number: int) -> DataFrame:
        """The page numbers of the rows that a harvest batch admitted."""
        return self._read("pool", T.StructType([ITEM[PAGE]]), SLOT).where(F.col(BATCH) == number).select(PAGE)

    def rounds(self) -> DataFrame:
        """What each finished harvest batch did."""
        return self._read("rounds", ROUNDS)

    def last_round(self) -> int:
        """The last harvest batch that is in the pool as a whole."""
        return self.rounds().agg(F.coalesce(F.max(BATCH), F.lit(SEED))).first()[0]

    def _deaths(self) -> DataFrame:
        return self._read("deaths", DEATHS, SLOT)

    def death_horizon(self, number: int) -> int:
        """The round up to which the deaths of outcome batch ``number`` remove rows; a batch
        that is repeated keeps the one it has recorded."""
        told = self._deaths().where(F.col(BATCH) == number).agg(F.max("upto")).first()[0]
        return self.last_round() if told is None else told

    def known(self, rows: DataFrame, before: int) -> DataFrame:
        """The keys of ``rows`` that the pool holds by batches below ``before``."""
        near, keys = near_keys(rows), rows.select(*KEYS).distinct()
        pool = self._read("pool", POOL, SLOT).where((F.col(BATCH) < before) & near).select(*KEYS, BATCH)
        deaths = self._deaths().where(near)
        held, dead = (keyed_join(table, keys, KEYS, "left_semi") for table in (pool, deaths))
        return living(held, dead).select(*KEYS)

    def _raised(self, rows: DataFrame, sweep: int) -> DataFrame:
        """K4: an eligible row's counter is what it came with plus the sweeps that saw it,
        up to number ``sweep``."""
        seen = self._read("seen", SEEN).where(F.col("round").isNotNull() & (F.col(BATCH) <= sweep))
        first = seen.groupBy("round").agg(F.min(BATCH).alias("first"))  # a row for each harvest
        joined = rows.join(first.withColumnRenamed("round", BATCH), BATCH, "left")
        more = F.coalesce(sweep - F.col("first") + 1, F.lit(0)).cast("int")
        status = F.when(eligible(F.col("anonymous")), F.col("status") + more).otherwise(F.col("status"))
        return joined.withColumn("status", status)

    def pool(self) -> DataFrame:
        """Admitted rows whose key has not died since, with their counters."""
        rows = self._read("pool", POOL, SLOT).where(F.col(BATCH) <= self.last_round())
        sweep = self._read("seen", SEEN).agg(F.coalesce(F.max(BATCH), F.lit(SEED))).first()[0]
        return self._raised(living(rows, self._deaths()), sweep).select(*POOL.fieldNames())

    def sweep(self, number: int) -> DataFrame:
        """Sweep ``number`` sees the pool as it stands now; the counters follow.

        Returns the rows it saw, with the counters it gave them. Repeating a sweep raises
        nothing twice: it keeps to the rounds that it has recorded.
        """
        seen = self._read("seen", SEEN)
        if seen.where(F.col(BATCH) == number).isEmpty():
            before = seen.where(F.col(BATCH) < number).agg(F.max("round")).first()[0]
            news = self.rounds().select(F.col(BATCH).alias("round")).distinct()
            if before is None:
                news = news.unionByName(self.spark.range(SEED, SEED + 1).select(F.col("id").alias("round")))
            else:
                news = news.where(F.col("round") > before)
            ran = self.spark.range(1).select(F.lit(None).cast("bigint").alias("round"))
            self.add(news.unionByName(ran), "seen", number)
        upto = self._read("seen", SEEN).where(F.col(BATCH) <= number).agg(F.max("round")).first()[0]
        rows = self._read("pool", POOL, SLOT).where(F.col(BATCH) <= upto)
        return self._raised(living(rows, self._deaths()), number).select(*POOL.fieldNames())

    def now(self) -> DataFrame:
        """Each URL whose last outcome is alive. The stream keeps the last outcome as its state
        and writes what changed; seeds have no arrival number and are the oldest."""
        last = latest(self._read("now", NOW_LOG).drop(BATCH), "url", "seq")
        return alive(last).select("url", "tm", "anonymous")

    def history(self) -> DataFrame:
        return latest(self._read("history", HISTORY), "_id", BATCH).drop(BATCH)

    def crawdetail(self) -> DataFrame:
        return self._read("crawdetail", CRAWDETAIL).drop(BATCH)

    def crawlog(self) -> DataFrame:
        return self._read("crawlog", CRAWLOG).drop(BATCH)

    def dispatched(self) -> DataFrame:
        return self._read("dispatch", RECORD).withColumnRenamed(BATCH, "sweep")
