"""Message codec queries on events in the shape of the sample topic's records."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from tidegate.functions import (
    add_wire_header,
    decode_avro,
    delimited_line,
    encode_avro,
    message_frame,
    parse_delimited,
    strip_wire_header,
)
from tidegate.functions.avro import CONSUMER_GOOD
from tidegate.plans import decode_messages, unknown_messages
from tidegate_queries.registry import GOODS, goods, query, table

SCHEMA_ID = 258
FIELDS = ("item", "retailer", "price", "txn_timestamp")

GOOD_LINE = """item || '|' || retailer || '|' || price || '|' ||
  strftime(txn_timestamp, '%Y-%m-%d %H:%M:%S')"""
# One line in fifty is cut short.
LINES = f"""(SELECT *, CASE WHEN event_id % 50 = 7 THEN item || '|' || retailer
  ELSE {GOOD_LINE} END AS line FROM {GOODS})"""
READABLE = "event_id % 50 <> 7"


def events(spark, sf_dir):
    return goods(table(spark, sf_dir, "events"))


def good_line():
    return delimited_line(*[F.col(name) for name in FIELDS])


def lines(rows):
    """Records as delimited text; one in fifty is cut short."""
    short = F.concat_ws("|", "item", "retailer")
    line = F.when(F.col("event_id") % 50 == 7, short).otherwise(good_line())
    return rows.withColumn("value", line)


def record():
    return F.struct(*FIELDS)


def plain_time(df):
    return df.withColumn("txn_timestamp", F.col("txn_timestamp").cast("timestamp_ntz"))


@query("delimited_encode", f"SELECT event_id, {GOOD_LINE} AS line FROM {GOODS}")
def delimited_encode(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", good_line().alias("line"))


@query(
    "delimited_parse",
    f"""
SELECT event_id, line AS value, item, retailer,
  CASE WHEN {READABLE} THEN price END AS price,
  CASE WHEN {READABLE} THEN date_trunc('second', txn_timestamp) END AS txn_timestamp,
  CASE WHEN {READABLE} THEN epoch_ms(date_trunc('second', txn_timestamp)) END AS event_ms
FROM {LINES}""",
)
def delimited_parse(spark, sf_dir):
    text = lines(events(spark, sf_dir)).select("event_id", "value")
    return plain_time(parse_delimited(text))


@query(
    "strip_wire_header",
    f"SELECT event_id, '0000000102' AS header, hex(encode({GOOD_LINE})) AS payload FROM {GOODS}",
)
def strip_header(spark, sf_dir):
    value = add_wire_header(F.encode(good_line(), "UTF-8"), SCHEMA_ID)
    messages = events(spark, sf_dir).select("event_id", value.alias("value"))
    return messages.select(
        "event_id",
        F.hex(F.substring("value", 1, 5)).alias("header"),
        F.hex(strip_wire_header(F.col("value"))).alias("payload"),
    )


@query(
    "utf8_serde_roundtrip",
    "SELECT doc_id, text, octet_length(encode(text)) AS n_bytes FROM documents",
)
def utf8_serde_roundtrip(spark, sf_dir):
    sent = table(spark, sf_dir, "documents").select(
        "doc_id", F.encode("text", "UTF-8").alias("body")
    )
    return sent.select(
        "doc_id",
        F.col("body").cast("string").alias("text"),
        F.length("body").cast("long").alias("n_bytes"),
    )


# Lengths and times are zigzag numbers; these are never negative, so twice the value.
# Times are cut, not rounded, to milliseconds; SQL's epoch_ms would round.
AVRO_HEX = """
  printf('%02X', 2 * octet_length(encode(item))) || hex(encode(item)) ||
  printf('%02X', 2 * octet_length(encode(retailer))) || hex(encode(retailer)) ||
  CASE WHEN cents < 128 THEN '02' || printf('%02X', cents)
       WHEN cents < 32768 THEN '04' || printf('%04X', cents)
       WHEN cents < 8388608 THEN '06' || printf('%06X', cents)
       ELSE '08' || printf('%08X', cents) END ||
  array_to_string([printf('%02X', ((ticks >> (7 * i)) & 127) +
      CASE WHEN (ticks >> (7 * (i + 1))) > 0 THEN 128 ELSE 0 END)
    for i in range(0, 8) if (ticks >> (7 * i)) > 0], '')"""


@query(
    "avro_encode",
    f"""
SELECT event_id, {AVRO_HEX} AS body
FROM (SELECT *, (price * 100)::BIGINT AS cents, epoch_us(txn_timestamp) // 1000 * 2 AS ticks
      FROM {GOODS})""",
)
def avro_encode(spark, sf_dir):
    body = encode_avro(record(), CONSUMER_GOOD)
    return events(spark, sf_dir).select("event_id", F.hex(body).alias("body"))


DECODED = "item, retailer, price, date_trunc('millisecond', txn_timestamp) AS txn_timestamp"


@query("avro_decode", f"SELECT event_id, {DECODED} FROM {GOODS}")
def avro_decode(spark, sf_dir):
    encoded = events(spark, sf_dir).select(
        "event_id", encode_avro(record(), CONSUMER_GOOD).alias("body")
    )
    decoded = decode_avro(F.col("body"), CONSUMER_GOOD).alias("good")
    return plain_time(encoded.select("event_id", decoded).select("event_id", "good.*"))


@query(
    "avro_decode_permissive",
    f"""
SELECT event_id, CASE WHEN {READABLE} THEN item END AS item,
  CASE WHEN {READABLE} THEN retailer END AS retailer, CASE WHEN {READABLE} THEN price END AS price,
  CASE WHEN {READABLE} THEN date_trunc('millisecond', txn_timestamp) END AS txn_timestamp
FROM {GOODS}""",
)
def avro_decode_permissive(spark, sf_dir):
    """One body in fifty lacks its last bytes; only those come out as null."""
    body = encode_avro(record(), CONSUMER_GOOD)
    encoded = events(spark, sf_dir).select("event_id", body.alias("body"))
    cut = F.when(F.col("event_id") % 50 == 7, F.expr("substring(body, 1, length(body) - 3)"))
    decoded = decode_avro(F.coalesce(cut, "body"), CONSUMER_GOOD, "PERMISSIVE").alias("good")
    return plain_time(encoded.select("event_id", decoded).select("event_id", "good.*"))


def topic(rows):
    """Records as the topic's messages: text key, Avro value behind a header."""
    body = encode_avro(record(), CONSUMER_GOOD)
    return message_frame(rows, F.col("key"), body, SCHEMA_ID)


@query("avro_roundtrip", f"SELECT key, {DECODED} FROM {GOODS}")
def avro_roundtrip(spark, sf_dir):
    return plain_time(decode_messages(topic(events(spark, sf_dir)), CONSUMER_GOOD))


# The topic's second schema: other order, one field renamed, one added.
SECOND = json.loads(CONSUMER_GOOD)
SECOND["fields"] = [
    {"name": "channel", "type": "string", "default": "store"},
    *reversed(SECOND["fields"][2:]),
    {"name": "shop", "aliases": ["retailer"], "type": "string"},
    SECOND["fields"][0],
]
SCHEMAS = {SCHEMA_ID: CONSUMER_GOOD, SCHEMA_ID + 1: json.dumps(SECOND)}
UNKNOWN_ID = 70_000


def topic_of_versions(rows):
    """A third of the messages in each of the two schemas, a third in one nobody gave."""
    online = F.concat(F.lit("web"), F.col("event_id") % 4).alias("channel")
    renamed = F.struct(online, "txn_timestamp", "price", F.col("retailer").alias("shop"), "item")
    first = add_wire_header(encode_avro(record(), CONSUMER_GOOD), SCHEMA_ID)
    second = add_wire_header(encode_avro(renamed, SCHEMAS[SCHEMA_ID + 1]), SCHEMA_ID + 1)
    other = add_wire_header(F.encode(good_line(), "UTF-8"), UNKNOWN_ID)
    turn = F.col("event_id") % 3
    value = F.when(turn == 0, first).when(turn == 1, second).otherwise(other)
    return rows.select(F.col("event_id").cast("string").cast("binary").alias("key"), value.alias("value"))


@query(
    "avro_decode_by_schema_id",
    f"""
SELECT event_id::VARCHAR AS key, CASE WHEN event_id % 3 = 0 THEN 'store' ELSE 'web' || event_id % 4 END AS channel,
  date_trunc('millisecond', txn_timestamp) AS txn_timestamp, price, retailer AS shop, item
FROM {GOODS} WHERE event_id % 3 <> 2""",
)
def avro_decode_by_schema_id(spark, sf_dir):
    """Each message by the schema it names, in the fields of the second."""
    messages = topic_of_versions(events(spark, sf_dir))
    return plain_time(decode_messages(messages, SCHEMAS[SCHEMA_ID + 1], schemas=SCHEMAS))


@query(
    "avro_unknown_schema_ids",
    f"""
SELECT event_id::VARCHAR AS key, '0000011170' || hex(encode({GOOD_LINE})) AS value,
  {UNKNOWN_ID}::BIGINT AS schema_id FROM {GOODS} WHERE event_id % 3 = 2""",
)
def avro_unknown_schema_ids(spark, sf_dir):
    unknown = unknown_messages(topic_of_versions(events(spark, sf_dir)), SCHEMAS)
    return unknown.select(F.col("key").cast("string").alias("key"), F.hex("value").alias("value"), "schema_id")


@query(
    "message_frame",
    f"""
SELECT hex(encode(key)) AS key, '0000000102' || {AVRO_HEX} AS value
FROM (SELECT *, (price * 100)::BIGINT AS cents, epoch_us(txn_timestamp) // 1000 * 2 AS ticks
      FROM {GOODS})""",
)
def message_frames(spark, sf_dir):
    return topic(events(spark, sf_dir)).select(
        F.hex("key").alias("key"), F.hex("value").alias("value")
    )


@query("struct_flatten", f"SELECT key, item, retailer, price, txn_timestamp FROM {GOODS}")
def struct_flatten(spark, sf_dir):
    nested = events(spark, sf_dir).select("key", record().alias("good"))
    return plain_time(nested.select("key", "good.*"))
