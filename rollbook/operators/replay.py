"""Pool membership over a whole log of sightings and deaths.

A key is a member iff its last event is a sighting. A sighting admits its key iff
the key's previous event is absent or a death: dead keys may come back.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
import rollbook
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T

from rollbook.operators.ingest import KEYS
from rollbook.session import settle

# What runs in tasks travels with its code: executors need not have the package.
cloudpickle.register_pickle_by_value(rollbook)

# Arrival numbers of one slice where events are cut by number.
SLICE_WIDTH = 1 << 20

_PART, _ROLE = "_part", "_role"
#: What a row of the scan is: an admission, a sighting that its part does not decide, the
#: last event of a part.
ADMITTED, FIRST, LAST = 0, 1, 2


def last_events(
    events: DataFrame, keys: Sequence[str] = KEYS, order: str = "seq", dead: str = "dead"
) -> DataFrame:
    """The last event of each key."""
    return events.groupBy(*keys).agg(
        F.max(order).alias(order), F.max_by(dead, order).alias(dead)
    )


def members(
    events: DataFrame, keys: Sequence[str] = KEYS, order: str = "seq", dead: str = "dead"
) -> DataFrame:
    """The keys that are in the pool at the end, with their last sighting."""
    return last_events(events, keys, order, dead).where(~F.col(dead)).drop(dead)


def _alike(one: pa.Array, other: pa.Array) -> pa.Array:
    """Null-safe equality."""
    both_null = pc.and_(pc.is_null(one), pc.is_null(other))
    return pc.or_(pc.fill_null(pc.equal(one, other), False), both_null)


def _scanner(keys: Sequence[str], dead: str, names: Sequence[str]):
    """Events of a part in order -> its admissions, told by the event before each; its first
    event if that is a sighting; its last event."""

    def told(rows: pa.RecordBatch, part: int, role: int) -> pa.RecordBatch:
        extra = [pa.array([part] * len(rows), pa.int64()), pa.array([role] * len(rows), pa.int32())]
        return pa.RecordBatch.from_arrays([*(rows[n] for n in names), *extra], [*names, _PART, _ROLE])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last = TaskContext.get().partitionId(), None
        for batch in batches:
            if not len(batch):
                continue
            known = batch if last is None else pa.Table.from_batches([last, batch]).combine_chunks().to_batches()[0]
            before, after = known.slice(0, len(known) - 1), known.slice(1)
            same = None
            for key in keys:
                alike = _alike(before[key], after[key])
                same = alike if same is None else pc.and_(same, alike)
            admits = pc.and_(pc.invert(after[dead]), pc.or_(pc.invert(same), before[dead]))
            yield told(after.filter(admits), part, ADMITTED)
            if last is None and not batch[dead][0].as_py():
                yield told(batch.slice(0, 1), part, FIRST)
            last = batch.slice(len(batch) - 1)
        if last is not None:
            yield told(last, part, LAST)

    return run


def admissions(
    events: DataFrame,
    keys: Sequence[str] = KEYS,
    order: str = "seq",
    dead: str = "dead",
    state: DataFrame | None = None,
) -> DataFrame:
    """The sightings that bring their key into the pool.

    ``order`` is a unique arrival number of any spread. A segmented prefix scan: the events
    are range partitioned by key and order, so a hot key is cut into as many parts as its
    share asks for. In a part each event is told by the one before it; only a part's first
    event is told by another part, namely by the last event of the part before. These are one
    row a part; they are compared at the driver, and say which first events count. ``state``
    (keys and ``dead``) is what was known before the log: it comes first in the order.
    """
    log = events
    if state is not None:
        known = state.select(*keys, dead).withColumn(order, F.lit(None).cast(events.schema[order].dataType))
        log = events.unionByName(known, allowMissingColumns=True)
    names = events.columns
    dealt = log.repartitionByRange(*keys, order).sortWithinPartitions(*keys, order)
    schema = T.StructType([*events.schema.fields, T.StructField(_PART, T.LongType()), T.StructField(_ROLE, T.IntegerType())])
    scanned = settle(dealt.mapInArrow(_scanner(keys, dead, names), schema), "replay")

    edges = scanned.where(F.col(_ROLE) != ADMITTED).select(*keys, dead, _PART, _ROLE).collect()  # two rows a part
    admitted, before = [], None
    for row in sorted(edges, key=lambda r: (r[_PART], r[_ROLE])):
        if row[_ROLE] == FIRST:
            if before is None or before[dead] or any(row[k] != before[k] for k in keys):
                admitted.append(row[_PART])
        else:
            before = row
    counts = (F.col(_ROLE) == ADMITTED) | ((F.col(_ROLE) == FIRST) & F.col(_PART).isin(admitted))
    found = scanned.where(counts).select(*names)
    return found if state is None else found.where(F.col(order).isNotNull())
