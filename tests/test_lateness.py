"""The batch replay of late records against a plain loop."""

import datetime as dt
import random
import re

import pytest

from tidegate.operators import flag_late, flag_late_by_slowest

START = dt.datetime(2024, 1, 1)


def recorded(seed, rows):
    """A third and more of the rows come from one source."""
    rng = random.Random(seed)
    offsets, out = {}, []
    for number in range(rows):
        source = rng.choice(["hot", "hot", "a", "b", None])
        offset = offsets.get(source, 0) + rng.choice([1, 1, 1, 40])
        offsets[source] = offset
        behind = rng.choice([0, 0, 2900, 3100, 9000])
        moment = START + dt.timedelta(milliseconds=number * 100 - behind)
        out.append((number, source, offset, None if rng.random() < 0.05 else moment))
    return out


def late_by_loop(rows, bound_ms):
    highest, late = {}, set()
    for number, source, _, moment in sorted(rows, key=lambda row: row[2]):
        if moment is None:
            continue
        top = highest.get(source)
        if top is not None and moment < top - dt.timedelta(milliseconds=bound_ms + 1):
            late.add(number)
        highest[source] = moment if top is None else max(top, moment)
    return late


@pytest.mark.parametrize("chunk", [1, 7, 100, 1 << 16])
def test_same_as_a_loop(spark, chunk):
    rows = recorded(chunk, 600)
    schema = "number INT, source STRING, place LONG, moment TIMESTAMP_NTZ"
    df = spark.createDataFrame(rows, schema).repartition(5)
    flagged = flag_late(df, "source", "place", "moment", chunk=chunk)
    assert flagged.columns == [*df.columns, "late"]
    got = flagged.collect()
    assert sorted(row.number for row in got) == list(range(600))
    expected = late_by_loop(rows, 3000)
    assert expected
    assert {row.number for row in got if row.late} == expected


def test_bound_is_exact_to_the_millisecond(spark):
    second = dt.timedelta(seconds=1)
    moments = [START, START - 3 * second - second / 1000, START - 3 * second - second / 500]
    rows = [(place, moment) for place, moment in enumerate(moments)]
    df = spark.createDataFrame(rows, "place LONG, moment TIMESTAMP_NTZ").selectExpr("0 AS s", "*")
    flags = {row.place: row.late for row in flag_late(df, "s", "place", "moment").collect()}
    assert flags == {0: False, 1: False, 2: True}


def test_records_are_shuffled_once(spark):
    df = spark.range(10).selectExpr(
        "id % 2 AS s", "id", "TIMESTAMP_NTZ '2024-01-01' AS moment", "'x' AS body"
    )
    plan = flag_late(df, "s", "id", "moment")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    # One shuffle carries records, the others only ranges: one row for each of them.
    assert len(re.findall(r"Exchange hashpartitioning\(s#\d+L, __range2", plan)) == 1
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 6


def arrived(seed, rows):
    """Places over all sources, with gaps; one source falls silent, another starts late."""
    rng = random.Random(seed)
    place, out = 0, []
    for number in range(rows):
        place += rng.choice([1, 1, 1, 2, 30])
        names = ["hot", "hot", "hot", None, "slow"] + ["early"] * (number < rows // 3) + ["new"] * (number > rows // 2)
        source = rng.choice(names)
        behind = rng.choice([0, 0, 2900, 3100, 9000]) + (1500 if source == "slow" else 0)
        moment = START + dt.timedelta(milliseconds=number * 100 - behind)
        clock = START + dt.timedelta(milliseconds=number * 100 + rng.choice([0, 3000 if number % 50 > 40 else 0]))
        out.append((number, source, place, None if rng.random() < 0.05 else moment, clock))
    return out


def late_by_slowest_loop(rows, bound_ms, idle_ms):
    top, seen, reached, late = {}, {}, None, set()
    for number, source, _, moment, clock in sorted(rows, key=lambda row: row[2]):
        active = [
            top[s] for s in top if idle_ms is None or seen[s] >= clock - dt.timedelta(milliseconds=idle_ms)
        ]
        if active:
            reached = min(active) if reached is None else max(reached, min(active))
        if moment and reached and moment < reached - dt.timedelta(milliseconds=bound_ms + 1):
            late.add(number)
        seen[source] = max(seen.get(source, clock), clock)
        if moment:
            top[source] = max(top.get(source, moment), moment)
    return late


FIVE = "number INT, source STRING, place LONG, moment TIMESTAMP_NTZ, clock TIMESTAMP"


@pytest.mark.parametrize("chunk", [7, 1 << 16])
@pytest.mark.parametrize("idle_ms", [None, 2000])
def test_slowest_source_same_as_a_loop(spark, chunk, idle_ms):
    rows = arrived(chunk, 400)
    df = spark.createDataFrame(rows, FIVE).repartition(5)
    flagged = flag_late_by_slowest(
        df, "source", "place", "moment", clock_col="clock", idle_ms=idle_ms, chunk=chunk
    )
    assert flagged.columns == [*df.columns, "late"]
    got = flagged.collect()
    assert sorted(row.number for row in got) == list(range(400))
    expected = late_by_slowest_loop(rows, 3000, idle_ms)
    assert expected
    assert {row.number for row in got if row.late} == expected


def test_a_silent_source_is_waited_for_until_it_is_idle(spark):
    second = dt.timedelta(seconds=1)
    rows = [(0, "silent", 0, START, START)]
    rows += [(n, "lively", n, START + n * second, START + n * second) for n in range(1, 30)]
    rows += [(30, "lively", 30, START + 5 * second, START + 30 * second)]
    df = spark.createDataFrame(rows, FIVE)

    def late(**idle):
        flagged = flag_late_by_slowest(df, "source", "place", "moment", chunk=4, **idle)
        return [r.number for r in flagged.where("late").collect()]

    assert late() == []
    assert late(clock_col="clock", idle_ms=60_000) == []
    assert late(clock_col="clock", idle_ms=5_000) == [30]
    with pytest.raises(ValueError, match="clock_col"):
        late(idle_ms=5_000)


def test_records_without_place_and_empty_streams(spark):
    df = spark.createDataFrame([(1, "a", None, START, START), (2, "a", 7, START, START)], FIVE)
    got = flag_late_by_slowest(df, "source", "place", "moment").collect()
    assert sorted((r.number, r.late) for r in got) == [(1, False), (2, False)]
    assert flag_late_by_slowest(df.limit(0), "source", "place", "moment").collect() == []


def test_no_task_replays_a_whole_stream(spark):
    """Records are replayed block by block; only rows that stand for blocks are dealt by source."""
    df = spark.createDataFrame(arrived(1, 50), FIVE)
    flagged = flag_late_by_slowest(df, "source", "place", "moment", chunk=8)
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    groups = re.findall(r"FlatMapGroupsInArrow \[([^\]#]*)", plan)
    assert groups and set(groups) == {"__block"}
    windows = re.findall(r"hashpartitioning\(([^)]*?), \d+\)", plan)
    assert any("__block" in keys for keys in windows)
