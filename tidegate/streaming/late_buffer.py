"""Late records held per key for a while, then handed over and forgotten.

The lateness itself is decided upstream (``split_late_stream``), so this operator
runs in processing time, where Spark drops no row, and only keeps the buffers and
their timers. Start its query within ``rocksdb_state``.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidegate.columns import named

# Workers get the processor below with the task, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FAST_MS = 5_000
REGULAR_MS = 30_000
#: Buffers of an item whose rows have a stable place to be dealt by.
SLOTS = 8
OUTPUT = "item STRING, value STRING"
# Spark's settings for state on disk, with changes uploaded batch by batch.
ROCKSDB_STATE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries started within keep their state in RocksDB, as timers and lists need."""
    before = {name: spark.conf.get(name, None) for name in ROCKSDB_STATE}
    for name, value in ROCKSDB_STATE.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def next_expiry(
    now: int,
    current: int | None,
    late: bool,
    fast_ms: int = FAST_MS,
    regular_ms: int = REGULAR_MS,
) -> int:
    """When a buffer expires after records came in at ``now``.

    Late records bring the expiry to ``fast_ms`` from now unless it is that near
    already; on-time records only start the regular one where there is none.
    """
    if late:
        soon = now + fast_ms
        return soon if current is None else min(current, soon)
    return now + regular_ms if current is None else current


class LateBuffer(StatefulProcessor):
    """One buffer per key and slot; emits what it held when it expires.

    Only a buffer that holds rows has a timer. On-time records leave the time at which
    they would let a buffer expire, and that is forgotten by itself when it has passed.
    """

    def __init__(self, fast_ms: int = FAST_MS, regular_ms: int = REGULAR_MS):
        self.fast_ms = fast_ms
        self.regular_ms = regular_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("held", "values ARRAY<STRING>")
        self.expiry = handle.getValueState("expiry", "at LONG")
        self.regular = handle.getValueState("regular", "at LONG", self.regular_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        any_late = False
        for chunk in rows:
            late = chunk.loc[chunk["late"], "value"]
            if len(late):
                any_late = True
                self.held.appendValue((late.tolist(),))
        now = timerValues.getCurrentProcessingTimeInMs()
        timer = int(self.expiry.get()[0]) if self.expiry.exists() else None
        current = timer
        if timer is None and self.regular.exists() and int(self.regular.get()[0]) > now:
            current = int(self.regular.get()[0])
        expiry = next_expiry(now, current, any_late, self.fast_ms, self.regular_ms)
        if not any_late and timer is None:
            if current is None:
                self.regular.update((expiry,))
        elif expiry != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(expiry)
            self.expiry.update((expiry,))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        for (values,) in self.held.get():
            yield pd.DataFrame({"item": key[0], "value": list(values)})
        self.held.clear()
        self.expiry.clear()
        self.regular.clear()

    def close(self) -> None:
        pass


def marks_for_slots(batches: Iterator[pa.RecordBatch], slots: int) -> Iterator[pa.RecordBatch]:
    """Late rows as they are; of on-time rows one mark per item, Arrow batch and slot.

    How rows fall into batches changes only how often a mark is repeated, and repeats
    have no effect.
    """
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        late = rows["late"]
        items = rows.filter(pc.invert(late)).group_by("item").aggregate([])["item"].to_pylist()
        marks = pa.table(
            {
                "item": pa.array([i for i in items for _ in range(slots)], pa.string()),
                "late": pa.array([False] * (len(items) * slots), pa.bool_()),
                "value": pa.nulls(len(items) * slots, pa.string()),
                "slot": pa.array(list(range(slots)) * len(items), pa.int32()),
            }
        )
        yield from pa.concat_tables([rows.filter(late), marks], promote_options="permissive").to_batches()


def hold_late_records(
    flagged: DataFrame,
    item_col: str = "item",
    value_col: str = "value",
    late_col: str = "late",
    place_cols: list[str] | None = None,
    slots: int | None = None,
    fast_ms: int = FAST_MS,
    regular_ms: int = REGULAR_MS,
) -> DataFrame:
    """Buffer the late rows of ``flagged`` by item; each comes out when it expires.

    One item, or copies of one row, may make up a large part of the stream. Name the
    columns that place a row in its source (a topic's partition and offset) and the late
    rows of an item are spread over ``slots`` buffers by a hash of them, ``SLOTS`` by
    default: a repeated task then puts each row where it was. Without ``place_cols``
    an item has one buffer. The expiry rule does not depend on the number: of on-time
    rows only the arrival matters, so they shrink to marks before the shuffle, and each
    slot gets them. An item with on-time rows only keeps one number in each slot, and no
    timer. Bound the source's intake per trigger: a buffer holds what came in within
    an expiry.
    """
    if slots is None:
        slots = SLOTS if place_cols else 1
    if slots > 1 and not place_cols:
        raise ValueError("Several slots need place_cols, or a repeated task could lose rows")
    late = F.coalesce(named(late_col), F.lit(False))
    slot = F.pmod(F.xxhash64(*[named(c) for c in place_cols]), F.lit(slots)) if slots > 1 else F.lit(0)
    rows = flagged.select(
        named(item_col).cast("string").alias("item"),
        late.alias("late"),
        F.when(late, named(value_col).cast("string")).alias("value"),
        slot.cast("int").alias("slot"),
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return marks_for_slots(batches, slots)

    placed = rows.mapInArrow(place, "item STRING, late BOOLEAN, value STRING, slot INT")
    return placed.groupBy("item", "slot").transformWithStateInPandas(
        statefulProcessor=LateBuffer(fast_ms, regular_ms),
        outputStructType=OUTPUT,
        outputMode="append",
        timeMode="ProcessingTime",
    )
