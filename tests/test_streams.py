"""Streams replayed file by file."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidegate.functions import parse_delimited
from tidegate.functions.avro import CONSUMER_GOOD
from tidegate.operators import flag_late, tumbling_aggregate
from tidegate.plans import on_time_to_text, windows_to_csv
from tidegate.streaming import (
    hold_late_records,
    late_split,
    rocksdb_state,
    split_late_stream,
    write_text_stream,
    write_windows_csv,
)
from tidegate.streaming.late_buffer import OUTPUT, ROCKSDB_STATE, next_expiry
from tidegate_queries.late import ROUTED, drain
from tidegate_queries.streams import windows_with_late_rows

NOW = {"availableNow": True}
START = dt.datetime(2024, 1, 1)
GOOD = "item STRING, retailer STRING, price DECIMAL(10,2), txn_timestamp TIMESTAMP"


def finish(query):
    try:
        assert query.awaitTermination(120)
    finally:
        query.stop()


def line(second, item="tea"):
    return f"{item}|IGA|1.00|{START + dt.timedelta(seconds=second):%Y-%m-%d %H:%M:%S}"


def arrive(spark, path, lines):
    spark.createDataFrame([(text,) for text in lines], "value STRING").coalesce(1).write.mode(
        "append"
    ).text(str(path))


def split(spark, path):
    parsed = parse_delimited(spark.readStream.text(f"{path}/in"))
    finish(split_late_stream(parsed, f"{path}/out", f"{path}/check", trigger=NOW))


def routed(spark, path):
    rows = spark.read.schema(ROUTED).parquet(f"{path}/out")
    return sorted((row.batch_id, row.route, row.value) for row in rows.collect())


BATCHES = [
    [line(10), line(2), "tea|IGA"],
    [line(7), line(6), line(30)],
    ["broken"],
    [line(27), line(26), line(31)],
]
ROUTES = sorted(
    [
        (0, "malformed", "tea|IGA"),
        (0, "on_time", line(2)),
        (0, "on_time", line(10)),
        (1, "late", line(6)),
        (1, "on_time", line(7)),
        (1, "on_time", line(30)),
        (2, "malformed", "broken"),
        (3, "late", line(26)),
        (3, "on_time", line(27)),
        (3, "on_time", line(31)),
    ]
)


def test_late_split_over_restarts(spark, tmp_path):
    for batch in BATCHES:
        arrive(spark, tmp_path / "in", batch)
        split(spark, tmp_path)
    assert routed(spark, tmp_path) == ROUTES


@pytest.mark.parametrize("when", ["before", "after"])
def test_late_split_repeats_a_failed_batch_alike(spark, tmp_path, monkeypatch, when):
    keep = late_split.keep_reached

    def failing(*arguments):
        if when == "after":
            keep(*arguments)
        raise OSError("lost")

    for number, batch in enumerate(BATCHES):
        arrive(spark, tmp_path / "in", batch)
        if number in (0, 1, 3):
            monkeypatch.setattr(late_split, "keep_reached", failing)
            with pytest.raises(Exception, match="lost"):
                split(spark, tmp_path)
            monkeypatch.setattr(late_split, "keep_reached", keep)
        split(spark, tmp_path)
    assert routed(spark, tmp_path) == ROUTES


def test_late_split_in_one_run(spark, tmp_path):
    """One query over several batches keeps its watermark without a restart."""
    for batch in BATCHES:
        arrive(spark, tmp_path / "in", batch)
    stream = spark.readStream.option("maxFilesPerTrigger", 1).text(f"{tmp_path}/in")
    finish(
        split_late_stream(
            parse_delimited(stream), f"{tmp_path}/out", f"{tmp_path}/check", trigger=NOW
        )
    )
    assert routed(spark, tmp_path) == ROUTES


def test_text_job_keeps_lines_as_they_were(spark, tmp_path):
    for batch in BATCHES:
        arrive(spark, tmp_path / "in", batch)
        lines = spark.readStream.text(f"{tmp_path}/in")
        finish(on_time_to_text(lines, f"{tmp_path}/out", f"{tmp_path}/check", trigger=NOW))
    for route in ("on_time", "late", "malformed"):
        kept = spark.read.text(f"{tmp_path}/out/span=*/batch_id=*/route={route}")
        expected = [value for _, was, value in ROUTES if was == route]
        assert sorted(row.value for row in kept.collect()) == sorted(expected)


def test_text_job_waits_for_the_slowest_partition(spark, tmp_path):
    for batch in ([line(100, "0"), line(50, "1")], [line(48, "1"), line(46, "0")]):
        arrive(spark, tmp_path / "in", batch)
        lines = spark.readStream.text(f"{tmp_path}/in")
        lines = lines.withColumn("partition", F.substring("value", 1, 1).cast("int"))
        finish(
            on_time_to_text(
                lines, f"{tmp_path}/out", f"{tmp_path}/check", idle_ms=None, trigger=NOW
            )
        )
    late = spark.read.text(f"{tmp_path}/out/span=*/batch_id=*/route=late").collect()
    assert [row.value for row in late] == [line(46, "0")]


def test_late_split_of_empty_batches(spark, tmp_path):
    for batch in ([line(10)], ["skip"], [line(1), line(11)]):
        arrive(spark, tmp_path / "in", batch)
        kept = spark.readStream.text(f"{tmp_path}/in").where("value <> 'skip'")
        parsed = parse_delimited(kept)
        finish(split_late_stream(parsed, f"{tmp_path}/out", f"{tmp_path}/check", trigger=NOW))
    assert routed(spark, tmp_path) == [
        (0, "on_time", line(10)),
        (2, "late", line(1)),
        (2, "on_time", line(11)),
    ]


def test_missing_event_time_state_is_an_error(spark, tmp_path):
    late_split.keep_reached(spark, f"{tmp_path}/state", 4, 5)
    assert late_split.reached_before(spark, f"{tmp_path}/state", 5) == 5
    with pytest.raises(RuntimeError):
        late_split.reached_before(spark, f"{tmp_path}/state", 7)


def test_slowest_source_holds_the_watermark_until_idle(spark, tmp_path, monkeypatch):
    """Sources are named by the item; the bound is three seconds."""
    clock = iter([0, 1, 7, 8])
    monkeypatch.setattr(late_split.time, "time", lambda: next(clock))
    batches = [
        [line(100, "a"), line(50, "b")],  # reached: 50, the slower source
        [line(110, "a"), line(48, "b"), line(46, "b")],  # only 46 is late; reached: still 50
        [line(120, "a"), line(47, "a")],  # 47 is in time; b idles by now, so reached: 120
        [line(116, "b"), line(115, "b"), line(117, "a")],  # late: 115 and 116
    ]
    for batch in batches:
        arrive(spark, tmp_path / "in", batch)
        parsed = parse_delimited(spark.readStream.text(f"{tmp_path}/in"))
        finish(
            split_late_stream(
                parsed, f"{tmp_path}/out", f"{tmp_path}/check", source_col="item", trigger=NOW
            )
        )
    late = [row[2] for row in routed(spark, tmp_path) if row[1] == "late"]
    assert late == [line(46, "b"), line(115, "b"), line(116, "b")]
    assert len(routed(spark, tmp_path)) == 10


def run_windows(spark, path, **settings):
    stream = spark.readStream.schema(GOOD).parquet(f"{path}/in")
    windows = tumbling_aggregate(stream)
    finish(write_windows_csv(windows, f"{path}/out", f"{path}/check", trigger=NOW, **settings))


def add_goods(spark, path, seconds):
    rows = [("tea", "IGA", None, START + dt.timedelta(seconds=s)) for s in seconds]
    spark.createDataFrame(rows, GOOD).coalesce(1).write.mode("append").parquet(f"{path}/in")


@pytest.mark.parametrize("settings", [{}, {"files_per_partition": 3}, {"partition_by": ()}])
def test_window_comes_once_and_late_rows_are_dropped(spark, tmp_path, settings):
    for seconds in ([1, 2, 11], [3, 16], [4, 40], [5, 41]):
        add_goods(spark, tmp_path, seconds)
        run_windows(spark, tmp_path, **settings)
    bounds = ["window_start STRING"], [
        "window_end STRING",
        "retailer STRING",
        "item_count LONG",
        "distinct_item_count LONG",
        "min_price_observed DECIMAL(10,2)",
        "max_price_observed DECIMAL(10,2)",
    ]
    flat = settings.get("partition_by") == ()
    schema = ", ".join(bounds[0] + bounds[1] if flat else bounds[1] + bounds[0])
    rows = spark.read.schema(schema).csv(f"{tmp_path}/out").collect()
    # Second 3 is still in time, 4 and 5 are not: their window has closed at second 16.
    assert sorted((row.window_start, row.window_end, row.item_count) for row in rows) == [
        ("2024-01-01 00:00:00", "2024-01-01 00:00:10", 3),
        ("2024-01-01 00:00:10", "2024-01-01 00:00:20", 2),
    ]


def test_text_sink(spark, tmp_path):
    arrive(spark, tmp_path / "in", ["a", "b|c"])
    lines = spark.readStream.text(f"{tmp_path}/in")
    finish(write_text_stream(lines, f"{tmp_path}/out", f"{tmp_path}/check", NOW))
    assert sorted(row.value for row in spark.read.text(f"{tmp_path}/out").collect()) == ["a", "b|c"]


@pytest.mark.parametrize(
    ("current", "late", "expiry"),
    [
        (None, False, 130_000),  # the first on-time record starts the regular expiry
        (107_000, False, 107_000),  # later ones leave it
        (None, True, 105_000),  # the first late record starts the fast one
        (130_000, True, 105_000),  # and brings a far one near
        (105_000, True, 105_000),
        (103_000, True, 103_000),  # but never puts a near one off
    ],
)
def test_expiry_rule(current, late, expiry):
    assert next_expiry(100_000, current, late) == expiry


def test_buffer_gives_back_every_late_record(spark, tmp_path):
    """One item holds most rows, many of them copies; nothing is lost or repeated."""
    rows = [
        ("hot" if n % 3 else f"i{n}", f"line {n if n % 5 else 0}", n % 2 == 0 if n % 7 else None)
        for n in range(700)
    ]
    schema = "item STRING, value STRING, late BOOLEAN"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
    held = hold_late_records(
        stream, place_cols=["value", "item"], slots=4, fast_ms=1000, regular_ms=2000
    )
    held = held.observe("expired", F.count(F.lit(1)).alias("rows"))
    before = {name: spark.conf.get(name, None) for name in ROCKSDB_STATE}
    with rocksdb_state(spark):
        query = (
            held.writeStream.format("parquet")
            .options(path=f"{tmp_path}/out", checkpointLocation=f"{tmp_path}/check")
            .trigger(processingTime="500 milliseconds")
            .start()
        )
    assert {name: spark.conf.get(name, None) for name in ROCKSDB_STATE} == before
    drain(query, sum(late is True for _, _, late in rows))
    got = spark.read.schema(OUTPUT).parquet(f"{tmp_path}/out").collect()
    assert sorted((r.item, r.value) for r in got) == sorted((i, v) for i, v, late in rows if late)


@pytest.mark.parametrize("slots", [1, 6])
def test_buffers_follow_one_rule_whatever_the_slots(spark, tmp_path, slots):
    """An on-time record's deadline releases late rows in all slots before their own would."""
    schema = "item STRING, value STRING, late BOOLEAN"

    def add(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    add([("a", None, False)])
    stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
    held = hold_late_records(
        stream, place_cols=["value"], slots=slots, fast_ms=600_000, regular_ms=8_000
    ).observe("expired", F.count(F.lit(1)).alias("rows"))
    with rocksdb_state(spark):
        query = (
            held.writeStream.format("parquet")
            .options(path=f"{tmp_path}/out", checkpointLocation=f"{tmp_path}/check")
            .trigger(processingTime="500 milliseconds")
            .start()
        )
    while not query.recentProgress or not any(p.numInputRows for p in query.recentProgress):
        assert not query.awaitTermination(1)
    add([("a", f"line {n}", True) for n in range(20)])
    drain(query, 20)  # with the rule of each slot alone this would take ten minutes
    got = spark.read.schema(OUTPUT).parquet(f"{tmp_path}/out").collect()
    assert sorted(r.value for r in got) == sorted(f"line {n}" for n in range(20))


def test_several_slots_need_a_place(spark):
    flagged = spark.createDataFrame([("a", "b", True)], "item STRING, value STRING, late BOOLEAN")
    with pytest.raises(ValueError):
        hold_late_records(flagged, slots=3)


def test_spans_are_merged_without_loss(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(late_split, "SPAN", 2)
    for batch in BATCHES:
        arrive(spark, tmp_path / "in", batch)
        split(spark, tmp_path)
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["span=0", "span=1"]
    path, archive = f"{tmp_path}/out", f"{tmp_path}/archive"

    def rows():
        read = late_split.read_spans(spark, path, archive, 3, ROUTED)
        return sorted((r.batch_id, r.route, r.value) for r in read.collect())

    assert rows() == ROUTES
    # A copy that was stopped is not in the list, so it is not read, and made anew.
    arrive(spark, tmp_path / "archive/rows/span=0", ["half a copy"])
    assert rows() == ROUTES
    assert late_split.merge_spans(spark, path, archive, 3, ROUTED) == [0]
    assert late_split.merge_spans(spark, path, archive, 3, ROUTED) == []
    assert rows() == ROUTES
    files = list((tmp_path / "archive/rows/span=0").rglob("*.parquet"))
    assert len(files) == 3  # one for each route


def test_permissive_windows_leave_out_broken_messages_only(spark, tmp_path):
    def body(minute, price=b"\x04\x03\xe7"):
        millis = 2 * (1_704_067_200_000 + 60_000 * minute)
        time = bytes((millis >> s & 127) | (128 if millis >> (s + 7) else 0) for s in range(0, 42, 7))
        return b"\x00\x00\x00\x00\x07\x06tea\x06IGA" + price + time

    wide = b"\x0a" + (10**10).to_bytes(5, "big", signed=True)
    values = [body(1), body(2, wide), body(3)[:-2], body(4), body(300)]
    rows = [(b"k", v) for v in values]
    spark.createDataFrame(rows, "key BINARY, value BINARY").write.parquet(f"{tmp_path}/in")
    messages = spark.readStream.schema("key BINARY, value BINARY").parquet(f"{tmp_path}/in")
    finish(
        windows_to_csv(
            messages, CONSUMER_GOOD, f"{tmp_path}/out", f"{tmp_path}/check",
            window="1 hour", mode="PERMISSIVE", trigger=NOW,
        )
    )
    schema = "window_end STRING, retailer STRING, item_count LONG"
    kept = spark.read.schema(schema).csv(f"{tmp_path}/out").collect()
    assert [(r.retailer, r.item_count) for r in kept] == [("IGA", 2)]


def test_window_folders_hold_few_files(spark, tmp_path):
    rows = [("tea", f"shop {n}", None, START + dt.timedelta(seconds=n % 20)) for n in range(400)]
    rows.append(("tea", "shop", None, START + dt.timedelta(seconds=500)))
    spark.createDataFrame(rows, GOOD).write.parquet(f"{tmp_path}/in")
    run_windows(spark, tmp_path)
    folders = list((tmp_path / "out").glob("window_start=*"))
    assert len(folders) == 2
    assert all(len(list(folder.glob("*.csv"))) <= 4 for folder in folders)


def test_late_rows_would_show_with_a_wide_watermark(spark):
    """The registered query leaves rows out; with an unlimited watermark they are all there."""
    def counted(watermark):
        windows = windows_with_late_rows(spark, "/root/testdata/sf0.001", watermark)
        return windows.agg(F.sum("item_count")).first()[0]

    assert counted("5 seconds") > (counted("3650 days") or 0)


def test_names_with_dots(spark):
    df = spark.createDataFrame(
        [("s", 1, START), ("s", 2, START - dt.timedelta(seconds=9))], "`a.b` STRING, `o.o` LONG, `t.t` TIMESTAMP"
    )
    assert [r.late for r in flag_late(df, "a.b", "o.o", "t.t").orderBy("`o.o`").collect()] == [False, True]
    windows = tumbling_aggregate(df, "t.t", "a.b", "o.o", "o.o")
    assert sum(r.item_count for r in windows.collect()) == 2
