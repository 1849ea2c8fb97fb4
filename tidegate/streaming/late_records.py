"""Late records judged, passed on, held and timed by one stateful operator.

Rows are dealt to a fixed number of shards. Each shard keeps a copy of the stream's
watermark in its state: of every Arrow batch the highest event time of each source goes to
all shards as a mark, so each learns how far the whole stream has come, whatever rows it
gets itself. A micro-batch is judged by the watermark the ones before it left, as in
``split_late_stream``: on-time and malformed rows come out at once, late rows are
held by item and come out when their item's buffer expires, as in
``hold_late_records``. Watermark, buffers and timers lie in one checkpoint and move together.
"""

from __future__ import annotations

import sys
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidegate.columns import named
from tidegate.streaming.late_buffer import FAST_MS, REGULAR_MS, next_expiry, rocksdb_state
from tidegate.streaming.late_split import LATE, MALFORMED, ON_TIME
from tidegate.streaming.writers import TRIGGER

# Workers get the processor below with the task, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Shards are groups of items times slots; the rows of an item lie in the slots of its group.
GROUPS = 8
SLOTS = 8
ROW, ITEM, SOURCE = 0, 1, 2
INNER = "shard INT, kind INT, item STRING, value STRING, micros LONG, source STRING"
OUTPUT = "item STRING, value STRING, route STRING"
#: Held values of one entry of an item's buffer.
TOGETHER = 1000


class LateRecords(StatefulProcessor):
    """One shard: the stream's watermark, and the late rows of some items until they expire."""

    def __init__(self, bound_ms: int, idle_ms: int | None, fast_ms: int, regular_ms: int):
        self.behind = (bound_ms + 1) * 1000
        self.idle_ms = idle_ms
        self.fast_ms = fast_ms
        self.regular_ms = regular_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.reached = handle.getValueState("reached", "batch LONG, before LONG, after LONG")
        self.sources = handle.getMapState("sources", "source STRING", "micros LONG, seen_ms LONG")
        self.held = handle.getMapState("held", "item STRING, part LONG", "values ARRAY<STRING>")
        self.buffers = handle.getMapState("buffers", "item STRING", "at LONG, parts LONG")
        self.due = handle.getMapState("due", "at LONG", "items ARRAY<STRING>")
        self.regular = handle.getMapState("regular", "item STRING", "at LONG", self.regular_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        batch, before, after = self.reached.get() if self.reached.exists() else (None, None, None)
        if batch != now:  # else this is more of the same micro-batch
            before = after
        limit = None if before is None else int(before) - self.behind
        late, on_time, tops = defaultdict(list), set(), {}
        for chunk in rows:
            marks = chunk[chunk["kind"] == SOURCE]
            for source, micros in marks.groupby("source", sort=False)["micros"].max().items():
                tops[source] = max(int(micros), tops.get(source, int(micros)))
            marks = chunk[(chunk["kind"] == ITEM) & chunk["micros"].notna()]
            moved = marks if limit is None else marks[marks["micros"] >= limit]
            on_time.update(_key(item) for item in moved["item"].unique())
            own = chunk[chunk["kind"] == ROW]
            route = pd.Series(ON_TIME, own.index)
            route[own["micros"].isna()] = MALFORMED
            if limit is not None:
                route[own["micros"] < limit] = LATE
            kept = own[route == LATE]
            for item, value in zip(kept["item"], kept["value"]):
                late[_key(item)].append(value)
            out = own.loc[route != LATE, ["item", "value"]]
            if len(out):
                yield out.assign(route=route[route != LATE])
        for item in on_time | late.keys():
            self._hold(item, late.get(item, []), now)
        self.reached.update((now, before, self._advance(after, tops, now)))

    def _advance(self, reached: int | None, tops: dict[str, int], now: int) -> int | None:
        """The event time reached with this micro-batch: the least of the sources that are not idle."""
        for source, micros in tops.items():
            known = self.sources.getValue((source,)) if self.sources.containsKey((source,)) else None
            self.sources.updateValue((source,), (max(micros, int(known[0])) if known else micros, now))
        active = [
            int(micros)
            for _, (micros, seen) in self.sources.iterator()
            if self.idle_ms is None or int(seen) >= now - self.idle_ms
        ]
        known = [] if reached is None else [int(reached)]
        return max([*known, *([min(active)] if active else [])], default=None)

    def _hold(self, item: str, values: list[str], now: int) -> None:
        at, parts = map(int, self.buffers.getValue((item,))) if self.buffers.containsKey((item,)) else (None, 0)
        current = at
        if at is None and self.regular.containsKey((item,)):
            regular = int(self.regular.getValue((item,))[0])
            current = regular if regular > now else None
        expiry = next_expiry(now, current, bool(values), self.fast_ms, self.regular_ms)
        if not values:
            if current is None:
                self.regular.updateValue((item,), (expiry,))
            return
        for start in range(0, len(values), TOGETHER):
            self.held.updateValue((item, parts), (values[start : start + TOGETHER],))
            parts += 1
        self.buffers.updateValue((item,), (expiry, parts))
        if expiry != at:  # a timer that came to be later than the buffer's finds nothing to do
            known = list(self.due.getValue((expiry,))[0]) if self.due.containsKey((expiry,)) else []
            if not known:
                self.handle.registerTimer(expiry)
            self.due.updateValue((expiry,), ([*known, item],))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at = expiredTimerInfo.getExpiryTimeInMs()
        items = list(self.due.getValue((at,))[0]) if self.due.containsKey((at,)) else []
        if items:
            self.due.removeKey((at,))
        for item in dict.fromkeys(items):
            if not self.buffers.containsKey((item,)) or int(self.buffers.getValue((item,))[0]) != at:
                continue
            for part in range(int(self.buffers.getValue((item,))[1])):
                values = list(self.held.getValue((item, part))[0])
                yield pd.DataFrame({"item": _item(item), "value": values, "route": LATE}, columns=["item", "value", "route"])
                self.held.removeKey((item, part))
            self.buffers.removeKey((item,))
            if self.regular.containsKey((item,)):
                self.regular.removeKey((item,))

    def close(self) -> None:
        pass


def _key(item: str | None) -> str:
    """An item as a key of state, which cannot be null."""
    return "-" if item is None or item != item else f"={item}"


def _item(key: str) -> str | None:
    return None if key == "-" else key[1:]


def with_marks(batches: Iterator[pa.RecordBatch], groups: int, slots: int) -> Iterator[pa.RecordBatch]:
    """The rows with their shards, the items' marks for all slots, the sources' marks for all shards.

    How rows fall into batches changes only how often a mark is repeated, and only the
    highest counts.
    """
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        shard = pc.add(pc.multiply(rows["group"], slots), rows["slot"])
        parts = [_marks(shard, ROW, rows["item"], rows["value"], rows["micros"], None)]
        timed = rows.filter(pc.is_valid(rows["micros"]))
        items = timed.group_by(["item", "group"]).aggregate([("micros", "max")])
        for slot in range(slots):
            shard = pc.add(pc.multiply(items["group"], slots), slot)
            parts.append(_marks(shard, ITEM, items["item"], None, items["micros_max"], None))
        sources = timed.group_by("source").aggregate([("micros", "max")])
        for shard in range(groups * slots):
            every = pa.array([shard] * len(sources), pa.int32())
            parts.append(_marks(every, SOURCE, None, None, sources["micros_max"], sources["source"]))
        yield from pa.concat_tables(parts).to_batches()


def _marks(shard, kind: int, item, value, micros, source) -> pa.Table:
    n = len(shard)
    text = [pa.nulls(n, pa.string()) if c is None else c.cast(pa.string()) for c in (item, value, source)]
    columns = [pc.cast(shard, pa.int32()), pa.array([kind] * n, pa.int32()), *text[:2], micros, text[2]]
    return pa.table(columns, names=[c.split()[0] for c in INNER.split(", ")])


def route_late_records(
    rows: DataFrame,
    place_cols: list[str],
    item_col: str = "item",
    value_col: str = "value",
    time_col: str = "txn_timestamp",
    source_col: str | None = None,
    bound_ms: int = 3000,
    idle_ms: int | None = 5000,
    fast_ms: int = FAST_MS,
    regular_ms: int = REGULAR_MS,
    groups: int = GROUPS,
    slots: int = SLOTS,
) -> DataFrame:
    """``item``, ``value`` and ``route`` of each row of the stream, once.

    A row without event time is malformed. ``place_cols`` place a row in its source (a
    topic's partition and offset); by their hash an item's rows are spread over
    ``slots`` shards, and a repeated task puts each row where it was. With ``source_col``
    the watermark is that of the slowest source that brought something within
    ``idle_ms``; without it the whole stream is one source, which is never idle. Rows without a
    source are one source. There are ``groups`` times ``slots`` shards; their number
    cannot change under a checkpoint. Start the query within ``rocksdb_state``.
    """
    source = F.lit("") if source_col is None else F.coalesce(named(source_col).cast("string"), F.lit(""))
    item = named(item_col).cast("string")
    placed = rows.select(
        item.alias("item"),
        named(value_col).cast("string").alias("value"),
        F.unix_micros(named(time_col).cast("timestamp")).alias("micros"),
        source.alias("source"),
        F.pmod(F.xxhash64(item), F.lit(groups)).cast("int").alias("group"),
        F.pmod(F.xxhash64(*[named(c) for c in place_cols]), F.lit(slots)).cast("int").alias("slot"),
    )

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return with_marks(batches, groups, slots)

    processor = LateRecords(bound_ms, None if source_col is None else idle_ms, fast_ms, regular_ms)
    return placed.mapInArrow(mark, INNER).groupBy("shard").transformWithStateInPandas(
        statefulProcessor=processor,
        outputStructType=OUTPUT,
        outputMode="append",
        timeMode="ProcessingTime",
    )


def late_records_to_files(
    rows: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, **settings
) -> StreamingQuery:
    """Run ``route_late_records`` into Parquet, one folder per route.

    The query's progress has the rows that came out of each batch, as ``routed``.
    """
    routed = route_late_records(rows, **settings).observe("routed", F.count(F.lit(1)).alias("rows"))
    writer = routed.writeStream.format("parquet").partitionBy("route").option("path", path)
    with rocksdb_state(rows.sparkSession):
        return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or TRIGGER)).start()
