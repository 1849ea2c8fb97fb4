"""The two streaming jobs, from message frames to files.

Both take the frame of a topic (``read_binary_topic``, ``read_text_topic``) or any
stream with the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegate.functions import (
    decode_avro,
    decode_versions,
    is_known,
    parse_delimited,
    schema_id,
    strip_wire_header,
)
from tidegate.operators import tumbling_aggregate
from tidegate.streaming import rocksdb_state, split_late_stream, write_windows_csv
from tidegate.streaming.writers import FILES_PER_PARTITION, write_parquet_stream


def decode_messages(
    messages: DataFrame, schema: str, mode: str = "FAILFAST", schemas: dict[int, str] | None = None
) -> DataFrame:
    """Key as text and the Avro record's fields, from binary ``key`` and ``value``.

    Without ``schemas`` all messages are read with ``schema``, whatever id they name. With
    ``schemas``, the writers' schemas by id, each is read with its own and brought into
    ``schema``; messages that name no known one are left out, and ``unknown_messages``
    has them.
    """
    value = F.col("value")
    if schemas is None:
        record = decode_avro(strip_wire_header(value), schema, mode)
    else:
        messages = messages.where(is_known(value, schemas))
        record = decode_versions(value, schemas, schema, mode)
    decoded = messages.select(F.col("key").cast("string").alias("key"), record.alias("record"))
    return decoded.select("key", "record.*")


def unknown_messages(messages: DataFrame, schemas: dict[int, str]) -> DataFrame:
    """The messages that name none of ``schemas``, whole, with the id they name (null without header).

    A null value is a deletion mark, not a message of an unknown schema.
    """
    value = F.col("value")
    unknown = messages.where(value.isNotNull() & ~is_known(value, schemas))
    return unknown.select("key", "value", schema_id(value).alias("schema_id"))


def unknown_to_files(
    messages: DataFrame, schemas: dict[int, str], path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Keep the messages of unknown schemas, to be decoded once their schemas are given.

    They are written as Parquet with key, value and schema_id, so ``decode_messages``
    reads the files like the topic.
    """
    return write_parquet_stream(unknown_messages(messages, schemas), path, checkpoint, trigger)


def windows_to_csv(
    messages: DataFrame,
    schema: str,
    path: str,
    checkpoint: str,
    window: str = "10 seconds",
    watermark: str = "5 seconds",
    mode: str = "FAILFAST",
    files_per_partition: int | None = FILES_PER_PARTITION,
    trigger: dict | None = None,
    schemas: dict[int, str] | None = None,
) -> StreamingQuery:
    """Avro messages to CSV rows per window and retailer, in folders by window start.

    With ``mode='PERMISSIVE'`` unreadable messages belong to no window and are left out.
    With ``schemas`` each message is read by the schema it names; run
    ``unknown_to_files`` beside this to keep those that name another one.
    Window state is kept in RocksDB, off the JVM heap.
    """
    records = decode_messages(messages, schema, mode, schemas)
    windows = tumbling_aggregate(records, window=window, watermark=watermark)
    with rocksdb_state(messages.sparkSession):
        return write_windows_csv(
            windows, path, checkpoint, files_per_partition=files_per_partition, trigger=trigger
        )


def on_time_to_text(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    bound_ms: int = 3000,
    idle_ms: int | None = 5000,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Delimited messages to text files, with late and malformed lines in their own folders.

    Messages that carry their topic's ``partition`` are judged by the slowest partition.
    """
    return split_late_stream(
        parse_delimited(messages),
        path,
        checkpoint,
        bound_ms=bound_ms,
        source_col="partition" if "partition" in messages.columns else None,
        idle_ms=idle_ms,
        file_type="text",
        columns=["value"],
        trigger=trigger,
    )
