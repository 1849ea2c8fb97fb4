"""Messages with ids, sent again and read once."""

import datetime as dt

from pyspark.sql import functions as F

from tidegate.functions import message_frame, message_id
from tidegate.sinks.topics import sendable
from tidegate.streaming import drop_repeats, rocksdb_state

START = dt.datetime(2024, 1, 1)
SCHEMA = (
    "key BINARY, value BINARY, headers ARRAY<STRUCT<key: STRING, value: BINARY>>, topic STRING, "
    "partition INT, offset LONG, timestamp TIMESTAMP"
)


def test_ids_tell_rows_apart_and_repeats_alike(spark):
    rows = [(1, "a", "bc"), (2, "ab", "c"), (3, None, "abc"), (4, "a", "bc"), (5, "", "abc")]
    df = spark.createDataFrame(rows, "n INT, x STRING, `y.z` STRING")
    payload = F.encode("x", "UTF-8")
    got = message_frame(df, F.col("n"), payload, 1, id_cols=["x", "y.z"]).select(message_id(F.col("headers")))
    ids = [bytes(r[0]) for r in got.collect()]
    assert len(ids[0]) == 32 and ids[0] == ids[3] and len(set(ids)) == 4
    plain = message_frame(df, F.col("n"), payload, 1)
    assert plain.columns == ["key", "value"] == sendable(plain.withColumn("n", F.lit(1))).columns
    assert sendable(message_frame(df, F.col("n"), payload, 1, ["n"])).columns == ["key", "value", "headers"]


def test_message_id_of_other_headers(spark):
    rows = [(None,), ([],), ([("trace", b"1")],), ([("trace", b"1"), ("message-id", b"2")],)]
    df = spark.createDataFrame(rows, "headers ARRAY<STRUCT<key: STRING, value: BINARY>>")
    assert [r[0] and bytes(r[0]) for r in df.select(message_id(F.col("headers"))).collect()] == [None, None, None, b"2"]


def test_repeats_are_dropped_over_restarts_and_nameless_messages_stay(spark, tmp_path):
    def arrive(rows):
        made = [
            (b"k", text.encode(), [("message-id", number)] if number else None, "t", 0, place, START + dt.timedelta(minutes=m))
            for text, number, place, m in rows
        ]
        spark.createDataFrame(made, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/topic")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/topic")
        with rocksdb_state(spark):
            query = (
                drop_repeats(stream, "10 minutes")
                .writeStream.format("parquet")
                .options(path=f"{tmp_path}/out", checkpointLocation=f"{tmp_path}/check")
                .trigger(availableNow=True)
                .start()
            )
        assert query.awaitTermination(60)
        return sorted(r.value.decode() for r in spark.read.schema(SCHEMA).parquet(f"{tmp_path}/out").collect())

    assert arrive([("a", b"1", 0, 0), ("a", b"1", 1, 0), ("b", b"2", 2, 1), ("c", None, 3, 1)]) == ["a", "b", "c"]
    assert arrive([("b", b"2", 4, 2), ("d", b"3", 5, 2), ("c", None, 6, 2)]) == ["a", "b", "c", "c", "d"]
