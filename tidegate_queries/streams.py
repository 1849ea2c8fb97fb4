"""Windowed aggregates, stream sources and stream sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegate.functions import message_frame, parse_delimited, strip_wire_header
from tidegate.functions.avro import CONSUMER_GOOD
from tidegate.operators import roll_up, sketch_windows, tumbling_aggregate, with_estimate
from tidegate.operators.sketches import standard_error
from tidegate.plans import windows_to_csv
from tidegate.streaming import drop_repeats, rocksdb_state, write_text_stream
from tidegate.workspace import fresh_folder
from tidegate_queries.codecs import LINES, READABLE, lines, plain_time, topic
from tidegate_queries.registry import GOODS, goods, query, table, table_stream

NOW = {"availableNow": True}
# Row by row streams may take their input in parts, so a failure repeats one part only.
PARTS = {"maxBytesPerTrigger": str(1 << 38)}

WINDOWS = f"""
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start,
  strftime(w + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS window_end, retailer,
  count(item) AS item_count, count(DISTINCT item) AS distinct_item_count,
  min(price) AS min_price_observed, max(price) AS max_price_observed
FROM (SELECT *, time_bucket(INTERVAL '1 hour', txn_timestamp) AS w FROM {GOODS})
GROUP BY w, retailer"""
CLOSED_WINDOWS = f"""{WINDOWS}
HAVING w + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 5 SECOND"""
WINDOW_SCHEMA = (
    "window_end STRING, retailer STRING, item_count LONG, distinct_item_count LONG, "
    "min_price_observed DECIMAL(10,2), max_price_observed DECIMAL(10,2), window_start STRING"
)


def finish(started: StreamingQuery) -> None:
    """Wait for a stream that ends by itself, however long its input takes."""
    try:
        started.awaitTermination()
    finally:
        started.stop()


def land(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Run ``stream`` over what is there now, into Parquet."""
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    finish(writer.option("path", path).trigger(**NOW).start())


def hourly(rows: DataFrame) -> DataFrame:
    return tumbling_aggregate(rows, window="1 hour", watermark="5 seconds")


@query("tumbling_window_agg", WINDOWS)
def tumbling_window_agg(spark, sf_dir):
    return hourly(goods(table(spark, sf_dir, "events")))


@query(
    "distinct_users_rolled_up",
    """
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS "rows",
  true AS close, true AS as_direct
FROM events GROUP BY 1, 2""",
)
def distinct_users_rolled_up(spark, sf_dir):
    """Distinct users of each day from sketches of its hours.

    ``close`` tells whether the estimate is within four standard errors of the exact count,
    ``as_direct`` whether it is that of a sketch of the whole day.
    """
    events = table(spark, sf_dir, "events")
    hours = sketch_windows(events, "ts", "event_type", "user_id")
    days = with_estimate(roll_up(hours, "event_type"))
    direct = with_estimate(roll_up(sketch_windows(events, "ts", "event_type", "user_id", "1 day"), "event_type"))
    exact = events.groupBy(F.date_trunc("day", "ts").alias("window_start"), "event_type").agg(
        F.count_distinct("user_id").alias("exact")
    )
    by = ["window_start", "event_type"]
    known = direct.select(*by, F.col("distinct_items").alias("direct")).join(exact, by)
    off = F.abs(F.col("distinct_items") - F.col("exact"))
    return days.join(known, by).select(
        F.date_format("window_start", "yyyy-MM-dd").alias("day"),
        "event_type",
        "rows",
        (off <= 4 * standard_error() * F.col("exact")).alias("close"),
        (F.col("distinct_items") == F.col("direct")).alias("as_direct"),
    )


# Every tenth event of the first half comes after all others, most when their windows have
# closed.
IN_TIME_WINDOWS = CLOSED_WINDOWS.replace(
    GOODS,
    f"""(SELECT g.* FROM {GOODS} g, (SELECT max(ts) AS top, min(epoch_us(ts))
    + (max(epoch_us(ts)) - min(epoch_us(ts))) // 2 AS cut FROM events)
  WHERE event_id % 10 <> 3 OR epoch_us(txn_timestamp) >= cut
    OR time_bucket(INTERVAL '1 hour', txn_timestamp) + INTERVAL 1 HOUR > top - INTERVAL 5 SECOND)""",
)


@query("stream_tumbling_agg", IN_TIME_WINDOWS)
def stream_tumbling_agg(spark, sf_dir):
    """Open windows stay in state, closed ones come out once, later rows for them are dropped."""
    return windows_with_late_rows(spark, sf_dir, "5 seconds")


def windows_with_late_rows(spark: SparkSession, sf_dir: str, watermark: str) -> DataFrame:
    """Two arrivals: the events, without some of the first half, and then those."""
    folder = fresh_folder(spark, "windows")
    events = table(spark, sf_dir, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = events.agg(F.min(micros), F.max(micros)).first()
    behind = (F.col("event_id") % 10 == 3) & (micros < low + (high - low) // 2)
    for arrived in (events.where(~behind), events.where(behind)):
        arrived.write.mode("append").parquet(f"{folder}/arrived")
        stream = spark.readStream.schema(events.schema).parquet(f"{folder}/arrived")
        windows = tumbling_aggregate(goods(stream), window="1 hour", watermark=watermark)
        land(windows, f"{folder}/rows", f"{folder}/checkpoint")
    return spark.read.schema(windows.schema).parquet(f"{folder}/rows")


@query("stream_csv_sink", CLOSED_WINDOWS)
def stream_csv_sink(spark, sf_dir):
    """The whole job: Avro messages behind a header, to CSV in folders by window."""
    folder = fresh_folder(spark, "windows-csv")
    messages = topic(goods(table_stream(spark, sf_dir, "events")))
    finish(
        windows_to_csv(
            messages,
            CONSUMER_GOOD,
            f"{folder}/rows",
            f"{folder}/checkpoint",
            window="1 hour",
            trigger=NOW,
        )
    )
    return spark.read.schema(WINDOW_SCHEMA).csv(f"{folder}/rows")


@query("stream_text_sink", f"SELECT line AS value FROM {LINES}")
def stream_text_sink(spark, sf_dir):
    folder = fresh_folder(spark, "text")
    text = lines(goods(table_stream(spark, sf_dir, "events", **PARTS)))
    finish(write_text_stream(text, f"{folder}/rows", f"{folder}/checkpoint", NOW))
    return spark.read.text(f"{folder}/rows")


@query(
    "stream_source_replay",
    f"""
SELECT key, item, retailer, CASE WHEN {READABLE} THEN price END AS price,
  CASE WHEN {READABLE} THEN date_trunc('second', txn_timestamp) END AS txn_timestamp
FROM {LINES}""",
)
def stream_source_replay(spark, sf_dir):
    """A file stream in the columns of a message source: binary key and value."""
    folder = fresh_folder(spark, "replay")
    messages = lines(goods(table_stream(spark, sf_dir, "events", **PARTS))).select(
        F.encode("key", "UTF-8").alias("key"), F.encode("value", "UTF-8").alias("value")
    )
    text = messages.select(F.col("key").cast("string"), F.col("value").cast("string"))
    records = parse_delimited(text).select("key", "item", "retailer", "price", "txn_timestamp")
    land(records, f"{folder}/rows", f"{folder}/checkpoint")
    return plain_time(spark.read.schema(records.schema).parquet(f"{folder}/rows"))


def id_range(events: DataFrame) -> tuple[int, int]:
    """The lowest event id, and how many ids there are from it to the highest."""
    low, high = events.agg(F.min("event_id"), F.max("event_id")).first()
    return low, high - low + 1


@query(
    "stream_resume_from_checkpoint",
    """
SELECT events.*, CASE WHEN (event_id - low) * 2 // span = 0 THEN 1 ELSE 2 END AS run
FROM events,
  (SELECT min(event_id) AS low, max(event_id) - min(event_id) + 1 AS span FROM events)""",
)
def stream_resume_from_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs on one checkpoint: the second gets only what came in between them."""
    folder = fresh_folder(spark, "resume")
    events = table(spark, sf_dir, "events")
    low, span = id_range(events)
    half = low + (span + 1) // 2
    arrivals = [F.col("event_id") < half, F.col("event_id") >= half]
    for run, arrived in enumerate(arrivals, start=1):
        events.where(arrived).write.mode("append").parquet(f"{folder}/arrived")
        stream = spark.readStream.schema(events.schema).parquet(f"{folder}/arrived")
        marked = stream.withColumn("run", F.lit(run))
        land(marked, f"{folder}/rows", f"{folder}/checkpoint")
    return spark.read.schema(marked.schema).parquet(f"{folder}/rows")


@query(
    "stream_messages_read_once",
    f"SELECT key, item || '|' || retailer || '|' || price AS payload FROM {GOODS}",
)
def stream_messages_read_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch of messages, and a third of it sent again, as after a retry."""
    folder = fresh_folder(spark, "read-once")
    rows = goods(table(spark, sf_dir, "events"))
    payload = F.encode(F.concat_ws("|", "item", "retailer", "price"), "UTF-8")
    place = {"topic": F.lit("goods"), "timestamp": F.current_timestamp()}
    schema = "key BINARY, value BINARY, headers ARRAY<STRUCT<key: STRING, value: BINARY>>, topic STRING, timestamp TIMESTAMP"
    for sent in (rows, rows.where("event_id % 3 = 0")):
        messages = message_frame(sent, F.col("key"), payload, 258, id_cols=["event_id"])
        messages.withColumns(place).write.mode("append").parquet(f"{folder}/topic")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/topic")
        once = drop_repeats(stream, place_cols=("topic",))
        with rocksdb_state(spark):
            land(once.select("key", "value"), f"{folder}/rows", f"{folder}/checkpoint")
    read = spark.read.schema("key BINARY, value BINARY").parquet(f"{folder}/rows")
    body = F.decode(strip_wire_header(F.col("value")), "UTF-8")
    return read.select(F.decode("key", "UTF-8").alias("key"), body.alias("payload"))
