"""Pool membership with removal and re-admission over a stream of events.

Two keyed processors, one after the other. The first has no state: it takes the events of a
key in one slice of ``width`` arrival numbers, so a hot key is sorted by many tasks, decides
every event that another one of the slice precedes, and sums the slice up in one row, its
first event and how it ends. The second has one value a key as state, whether the key's
last event was a death; it sees one row a slice, and decides the first events. Decided
sightings pass it in lanes of their own, a slice each, and leave no state.

Nothing that was written before is read again; a batch costs its own events and the
state of its keys. Events of a batch may come in any order; those of a later batch are later.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import rollbook
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from rollbook.operators.replay import SLICE_WIDTH
from rollbook.streaming.follow import landed_files, started, state_on_disk

# What runs in tasks travels with its code: executors need not have the package.
cloudpickle.register_pickle_by_value(rollbook)

#: Columns between the processors: the slice, the lane, and for a slice's first event
#: whether its last one is a death, and that one's number.
_SLICE, _LANE, _ENDS_DEAD, _ENDS = "_slice", "_lane", "_ends_dead", "_ends"
FIRST = "first"


class WithinSlice(StatefulProcessor):
    """Events of one key and slice -> its sightings after a death, and its first event."""

    def __init__(self, names: Sequence[str]):
        self.names = list(names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        events = sorted((r.asDict() for r in rows), key=lambda r: r["seq"])
        kind = Row(*self.names)
        for before, event in zip(events, events[1:]):
            if before["dead"] and not event["dead"]:
                event = event | {_LANE: str(event[_SLICE])}
                yield kind(*map(event.get, self.names))
        first = events[0] | {_LANE: FIRST, _ENDS_DEAD: events[-1]["dead"], _ENDS: events[-1]["seq"]}
        yield kind(*map(first.get, self.names))


class AcrossSlices(StatefulProcessor):
    """One row a slice of a key, and lanes of decided sightings -> the sightings that admit."""

    def __init__(self, names: Sequence[str]):
        self.names = list(names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "dead boolean, seq long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        kind = Row(*self.names)
        if key[-1] != FIRST:
            for r in rows:
                yield kind(*[r[n] for n in self.names])
            return
        known = self.last.get()
        dead, seq = (True, None) if known is None else known
        for r in sorted(rows, key=lambda r: r[_SLICE]):
            if dead and not r["dead"]:
                yield kind(*[r[n] for n in self.names])
            dead, seq = r[_ENDS_DEAD], r[_ENDS]
        self.last.update((dead, seq))


def admitted_events(events: DataFrame, keys: Sequence[str], width: int = SLICE_WIDTH) -> DataFrame:
    """The sightings of a stream of events that bring their key into the pool."""
    passed = events.schema.fields
    kinds = {_SLICE: T.LongType(), _LANE: T.StringType(), _ENDS_DEAD: T.BooleanType(), _ENDS: T.LongType()}
    between = T.StructType([*passed, *[T.StructField(name, kind) for name, kind in kinds.items()]])
    sliced = events.withColumn(_SLICE, F.expr(f"seq div {int(width)}"))
    decided = sliced.groupBy(*keys, _SLICE).transformWithState(WithinSlice(between.names), between, "Append", "None")
    out = T.StructType([f for f in passed if f.name != "dead"])
    return decided.groupBy(*keys, _LANE).transformWithState(AcrossSlices(out.names), out, "Append", "None")


def ledger_stream(
    spark: SparkSession,
    landed: str,
    root: str,
    schema: T.StructType,
    keys: Sequence[str],
    width: int = SLICE_WIDTH,
    pause: str | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Events need ``keys``, ``seq`` (arrival number) and ``dead``. Admissions go to a file sink,
    which has each batch once."""
    with state_on_disk(spark):
        admitted = admitted_events(landed_files(spark, landed, schema, files_per_batch), keys, width)
        writer = admitted.writeStream.outputMode("append").format("parquet").option("path", f"{root}/admissions")
        return started(spark, writer, f"{root}/_ledger", pause, [f"{root}/admissions"])


def read_admissions(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    kept = T.StructType([f for f in schema.fields if f.name != "dead"])
    return spark.read.schema(kept).parquet(f"{root}/admissions")


def read_members(spark: SparkSession, root: str, keys: Sequence[str]) -> DataFrame:
    """The keys whose last event is no death, with its number, out of the stream's state."""
    state = (
        spark.read.format("statestore").option("operatorId", 0).option("stateVarName", "last").load(f"{root}/_ledger")
    )
    return state.where(~F.col("value.dead")).select(*[F.col(f"key.{k}").alias(k) for k in keys], "value.seq")
