"""Late-record queries: the batch replay, the stream split, and the keyed buffer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions import parse_delimited
from tidegate.operators import flag_late, flag_late_by_slowest
from tidegate.streaming import hold_late_records, late_records_to_files, rocksdb_state, split_late_stream
from tidegate.streaming.late_buffer import OUTPUT
from tidegate.streaming.late_split import LATE, MALFORMED
from tidegate.workspace import fresh_folder
from tidegate_queries.codecs import LINES, READABLE, lines
from tidegate_queries.registry import goods, query, table
from tidegate_queries.streams import NOW, PARTS, finish, id_range

SLICES = 4

REPLAY = """
SELECT event_id, coalesce(ts < top - INTERVAL 3001 MILLISECOND, false) AS late FROM (
  SELECT event_id, ts, max(ts) OVER (PARTITION BY user_id % 3 ORDER BY arrival
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top
  FROM (SELECT *, event_id + CASE WHEN event_id % 10 = 0 THEN 40 ELSE 0 END AS arrival
        FROM events))"""


def arrivals(spark, sf_dir):
    """Events of three sources; every tenth event arrives forty places late."""
    held_back = F.when(F.col("event_id") % 10 == 0, 40).otherwise(0)
    return table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        (F.col("user_id") % 3).alias("source"),
        (F.col("event_id") + held_back).alias("arrival"),
    )


def replayed(spark, sf_dir):
    return flag_late(arrivals(spark, sf_dir), "source", "arrival", "ts")


@query("late_records", f"SELECT event_id FROM ({REPLAY}) WHERE late")
def late_records(spark, sf_dir):
    return replayed(spark, sf_dir).where("late").select("event_id")


@query("on_time_records", f"SELECT event_id FROM ({REPLAY}) WHERE NOT late")
def on_time_records(spark, sf_dir):
    return replayed(spark, sf_dir).where("NOT late").select("event_id")


def slowest(active: str) -> str:
    """The replay under the slowest of the sources that ``active`` holds for, one record a second."""
    sources = range(3)
    tops = ", ".join(
        f"max(ts) FILTER (source = {s}) OVER before AS top{s}, max(arrival) FILTER (source = {s}) OVER before AS seen{s}"
        for s in sources
    )
    least = ", ".join(f"CASE WHEN {active.format(s)} THEN top{s} END" for s in sources)
    return f"""
SELECT event_id FROM (
  SELECT event_id, ts, max(least({least})) OVER (ORDER BY arrival) AS reached FROM (
    SELECT *, {tops} FROM (SELECT *, user_id % 3 AS source,
        event_id + CASE WHEN event_id % 10 = 0 THEN 40 ELSE 0 END AS arrival FROM events)
    WINDOW before AS (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)))
WHERE ts < reached - INTERVAL 3001 MILLISECOND"""


@query("late_records_min_source", slowest("seen{0} IS NOT NULL"))
def late_records_min_source(spark, sf_dir):
    """One watermark for the stream, that of the slowest source."""
    flagged = flag_late_by_slowest(arrivals(spark, sf_dir), "source", "arrival", "ts")
    return flagged.where("late").select("event_id")


@query("late_records_idle_sources", slowest("seen{0} >= arrival - 3"))
def late_records_idle_sources(spark, sf_dir):
    """The same, without waiting for sources that brought nothing for three seconds."""
    timed = arrivals(spark, sf_dir).withColumn("clock", F.timestamp_seconds("arrival"))
    flagged = flag_late_by_slowest(timed, "source", "arrival", "ts", clock_col="clock", idle_ms=3000)
    return flagged.where("late").select("event_id")


# Every tenth event comes one batch after its neighbours.
BATCHES = f"""
WITH arrived AS (
  SELECT event_id, item, retailer, line,
    CASE WHEN {READABLE} THEN date_trunc('second', txn_timestamp) END AS t,
    ((event_id - low) * {SLICES} // span + CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END)::INTEGER
      AS batch_id
  FROM {LINES},
    (SELECT min(event_id) AS low, max(event_id) - min(event_id) + 1 AS span FROM events)),
tops AS (
  SELECT batch_id, max(max(t)) OVER (ORDER BY batch_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM arrived GROUP BY batch_id),
routed AS (
  SELECT event_id, item, line, batch_id, CASE WHEN t IS NULL THEN 'malformed'
    WHEN t < top - INTERVAL 3001 MILLISECOND THEN 'late' ELSE 'on_time' END AS route
  FROM arrived JOIN tops USING (batch_id))"""
SPLIT = ["event_id", "value", "batch_id", "route"]
ROUTED = "event_id LONG, value STRING, item STRING, batch_id INT, route STRING"


def replay(spark: SparkSession, sf_dir: str, folder: str, run) -> None:
    """Land the events batch by batch, and ``run`` the stream of them over each."""
    rows = lines(goods(table(spark, sf_dir, "events"))).select("event_id", "value")
    low, span = id_range(rows)
    place = F.expr(f"(event_id - {low}) * {SLICES} div {span}")
    batch = place + F.when(F.col("event_id") % 10 == 0, 1).otherwise(0)
    for number in range(SLICES + 1):
        first, end = (low - (-n * span // SLICES) for n in (number - 1, number + 1))
        near = (F.col("event_id") >= first) & (F.col("event_id") < end)
        arrived = rows.where(near & (batch == number))
        arrived.write.mode("append").parquet(f"{folder}/arrived")
        run(arriving(spark, folder))


def arriving(spark: SparkSession, folder: str) -> DataFrame:
    return parse_delimited(spark.readStream.schema("event_id LONG, value STRING").parquet(f"{folder}/arrived"))


def split_replay(spark: SparkSession, sf_dir: str, folder: str, **settings) -> str:
    """Split the events' stream; gives the folder of the result."""

    def run(parsed):
        finish(split_late_stream(parsed, f"{folder}/split", f"{folder}/checkpoint", trigger=NOW, **settings))

    replay(spark, sf_dir, folder, run)
    return f"{folder}/split"


@query("stream_late_split", f"{BATCHES} SELECT event_id, line AS value, batch_id, route FROM routed")
def stream_late_split(spark, sf_dir):
    split = split_replay(spark, sf_dir, fresh_folder(spark, "late-split"))
    return spark.read.schema(ROUTED).parquet(split).select(*SPLIT)


@query(
    "stream_late_split_by_source",
    f"""
{BATCHES},
steps AS (SELECT DISTINCT batch_id FROM arrived),
starts AS (SELECT retailer, min(batch_id) AS first_batch FROM arrived GROUP BY retailer),
reached AS (
  SELECT s.batch_id, r.retailer,
    max(max(a.t)) OVER (PARTITION BY r.retailer ORDER BY s.batch_id) AS top
  FROM steps s JOIN starts r ON s.batch_id >= r.first_batch
  LEFT JOIN arrived a ON a.batch_id = s.batch_id AND a.retailer = r.retailer
  GROUP BY s.batch_id, r.retailer),
slowest AS (SELECT batch_id, min(top) AS top FROM reached GROUP BY batch_id),
floors AS (SELECT batch_id, max(top) OVER (ORDER BY batch_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM slowest)
SELECT event_id, line AS value, batch_id, CASE WHEN t IS NULL THEN 'malformed'
  WHEN t < floors.top - INTERVAL 3001 MILLISECOND THEN 'late' ELSE 'on_time' END AS route
FROM arrived JOIN floors USING (batch_id)""",
)
def stream_late_split_by_source(spark, sf_dir):
    """The watermark waits for the slowest of the sources, here the retailers."""
    folder = fresh_folder(spark, "late-split-source")
    split = split_replay(spark, sf_dir, folder, source_col="retailer", idle_ms=None)
    return spark.read.schema(ROUTED).parquet(split).select(*SPLIT)


@query("late_buffer", f"{BATCHES} SELECT item, line AS value FROM routed WHERE route = 'late'")
def late_buffer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The split stream's late records, as their buffers hand them over on expiry."""
    folder = fresh_folder(spark, "late-buffer")
    split = split_replay(spark, sf_dir, folder)
    expected = spark.read.schema(ROUTED).parquet(split).where(F.col("route") == LATE).count()
    stream = spark.readStream.schema(ROUTED).options(**PARTS).parquet(split)
    routed = stream.where(F.col("route") != MALFORMED)
    flagged = routed.select("event_id", "item", "value", (F.col("route") == LATE).alias("late"))
    expired = hold_late_records(flagged, place_cols=["event_id"]).observe("expired", F.count(F.lit(1)).alias("rows"))
    writer = expired.writeStream.format("parquet").option("path", f"{folder}/expired")
    writer = writer.option("checkpointLocation", f"{folder}/buffer-checkpoint")
    with rocksdb_state(spark):
        started = writer.trigger(processingTime="1 second").start()
    drain(started, expected)
    return spark.read.schema(OUTPUT).parquet(f"{folder}/expired")


@query("late_records_one_operator", f"{BATCHES} SELECT item, line AS value, route FROM routed")
def late_records_one_operator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records of the stream by route: the late ones as their buffers hand them over."""
    folder = fresh_folder(spark, "late-records")

    trigger, schema = {"processingTime": "500 milliseconds"}, "item STRING, value STRING, route STRING"
    read = 0

    def start(parsed):
        return late_records_to_files(
            parsed, f"{folder}/routed", f"{folder}/checkpoint", trigger, place_cols=["event_id"]
        )

    def run(parsed):  # timers keep the stream going, so it is stopped when it has read what landed
        nonlocal read
        landed = spark.read.parquet(f"{folder}/arrived").count()
        watch(start(parsed), landed - read, lambda step: step.numInputRows)
        read = landed

    replay(spark, sf_dir, folder, run)
    waiting = read - spark.read.schema(schema).parquet(f"{folder}/routed").count()
    watch(start(arriving(spark, folder)), waiting, given("routed"))
    return spark.read.schema(schema).parquet(f"{folder}/routed")


def given(metric: str):
    """How many rows a step gave, by what it observed."""
    return lambda step: step.observedMetrics[metric]["rows"] if metric in step.observedMetrics else 0


def drain(started, expected: int) -> None:
    """Stop a stream that has timers, and so never ends, once it gave ``expected`` rows."""
    watch(started, expected, given("expired"))


def watch(started, expected: int, rows) -> None:
    """Stop a stream once the ``rows`` of its steps come to ``expected``."""
    seen = {}
    try:
        while sum(seen.values()) < expected:
            if started.awaitTermination(1):  # raises what made it fail, if anything did
                raise RuntimeError("The stream ended before its buffers expired")
            seen |= {step.batchId: rows(step) for step in started.recentProgress}
    finally:
        started.stop()
