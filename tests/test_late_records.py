"""Late records judged, held and timed by one operator."""

import datetime as dt
import time

import pyarrow as pa
import pytest

from tidegate.streaming import late_records_to_files
from tidegate.streaming.late_records import ITEM, ROW, SOURCE, with_marks
from tidegate_queries.late import given, watch

START = dt.datetime(2024, 1, 1)
SCHEMA = "item STRING, value STRING, moment TIMESTAMP, source STRING"


def at(second):
    return START + dt.timedelta(seconds=second)


class Replay:
    """Batches of (item, value, second, source), each read by a run of its own."""

    def __init__(self, spark, path, **settings):
        self.spark, self.path, self.sent = spark, path, 0
        self.settings = {"place_cols": ["value"], "time_col": "moment", "fast_ms": 1000, "regular_ms": 60_000} | settings

    def start(self):
        stream = self.spark.readStream.schema(SCHEMA).parquet(f"{self.path}/in")
        trigger = {"processingTime": "200 milliseconds"}
        return late_records_to_files(stream, f"{self.path}/out", f"{self.path}/check", trigger, **self.settings)

    def batch(self, rows):
        rows = [(i, v, None if s is None else at(s), source) for i, v, s, source in rows]
        frame = self.spark.createDataFrame(rows, SCHEMA).coalesce(1)
        frame.write.mode("append").parquet(f"{self.path}/in")
        watch(self.start(), len(rows), lambda step: step.numInputRows)
        self.sent += len(rows)

    def routes(self):
        out = "item STRING, value STRING, route STRING"
        waiting = self.sent - self.spark.read.schema(out).parquet(f"{self.path}/out").count()
        watch(self.start(), waiting, given("routed"))
        got = self.spark.read.schema(out).parquet(f"{self.path}/out").collect()
        assert len(got) == self.sent  # each row once
        return {r.value: (r.item, r.route) for r in got}


def test_every_row_comes_out_once_by_its_route(spark, tmp_path):
    """The watermark of batches that one item brought judges the rows of all others, over restarts."""
    replay = Replay(spark, tmp_path, groups=3, slots=2)
    replay.batch([("tea", f"first {n}", n, None) for n in range(20)] + [("tea", "no time", None, None)])
    replay.batch(
        [("tea", f"late {n}", 10, None) for n in range(30)]  # a hot item
        + [("pot", "edge", 15.999, None), ("pot", "past", 15.998, None), (None, "nameless", 3, None)]
        + [(None, "nameless on time", 60, None), ("", "empty", 2, None)]
    )
    replay.batch([("cup", "behind the second", 50, None), ("cup", "ahead", 58, None)])
    got = replay.routes()
    assert {v for v, (_, route) in got.items() if route == "malformed"} == {"no time"}
    late = {f"late {n}" for n in range(30)} | {"past", "nameless", "empty", "behind the second"}
    assert {v for v, (_, route) in got.items() if route == "late"} == late
    assert got["nameless"][0] is None and got["empty"][0] == "" and got["late 3"][0] == "tea"


def test_slowest_source_holds_the_watermark_until_idle(spark, tmp_path):
    replay = Replay(spark, tmp_path, source_col="source", idle_ms=None, groups=2, slots=2)
    replay.batch([("tea", "a", 100, "quick"), ("tea", "b", 10, "slow"), ("tea", "c", 50, None)])
    replay.batch([("tea", "held", 20, "quick"), ("tea", "behind all", 3, "quick")])
    got = replay.routes()
    assert got["held"][1] == "on_time" and got["behind all"][1] == "late"


def test_idle_sources_are_not_waited_for(spark, tmp_path):
    replay = Replay(spark, tmp_path, source_col="source", idle_ms=2000, groups=2, slots=2)
    replay.batch([("tea", "a", 100, "quick"), ("tea", "b", 10, "slow")])
    time.sleep(2.5)
    replay.batch([("tea", "c", 101, "quick")])
    replay.batch([("tea", "d", 20, "quick")])
    assert replay.routes()["d"][1] == "late"


@pytest.mark.parametrize("rows", [0, 7])
def test_marks_reach_every_shard(rows):
    batch = pa.RecordBatch.from_pydict(
        {
            "item": [f"i{n % 2}" for n in range(rows)],
            "value": [str(n) for n in range(rows)],
            "micros": [None if n == 3 else n for n in range(rows)],
            "source": ["s" if n < 5 else "t" for n in range(rows)],
            "group": pa.array([n % 2 for n in range(rows)], pa.int32()),
            "slot": pa.array([n % 4 for n in range(rows)], pa.int32()),
        },
        pa.schema(
            [("item", "string"), ("value", "string"), ("micros", "int64"), ("source", "string"), ("group", "int32"), ("slot", "int32")]
        ),
    )
    out = pa.Table.from_batches(with_marks([batch], 2, 4)).to_pylist() if rows else []
    assert sum(r["kind"] == ROW for r in out) == rows
    sources = {(r["shard"], r["source"], r["micros"]) for r in out if r["kind"] == SOURCE}
    assert sources == ({(s, *top) for s in range(8) for top in (("s", 4), ("t", 6))} if rows else set())
    items = {(r["shard"], r["item"], r["micros"]) for r in out if r["kind"] == ITEM}
    assert items == ({(g * 4 + s, f"i{g}", (6, 5)[g]) for g in (0, 1) for s in range(4)} if rows else set())
    assert not rows or list(with_marks([batch.slice(0, 0)], 2, 4)) == []
