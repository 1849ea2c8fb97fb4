"""Message frames to a topic, through Spark's Kafka sink (at least once)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def write_topic(
    messages: DataFrame, servers: str, topic: str, props: Mapping[str, object] | None = None
) -> None:
    """Send a batch of ``(key, value)`` messages, with their ``headers`` if there are any."""
    options = topic_sink_options(servers, topic, props)
    sendable(messages).write.format("kafka").options(**options).save()


def write_topic_stream(
    messages: DataFrame,
    servers: str,
    topic: str,
    checkpoint: str,
    props: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Send ``(key, value)`` messages as they arrive, with their ``headers`` if there are any."""
    options = topic_sink_options(servers, topic, props)
    writer = sendable(messages).writeStream.format("kafka").options(**options)
    return writer.option("checkpointLocation", checkpoint).start()


def sendable(messages: DataFrame) -> DataFrame:
    """The columns that the sink takes."""
    return messages.select(*[c for c in ("key", "value", "headers") if c in messages.columns])


def topic_sink_options(
    servers: str, topic: str, props: Mapping[str, object] | None = None
) -> dict[str, object]:
    """Writer options for one topic."""
    return {"kafka.bootstrap.servers": servers, "topic": topic, **(props or {})}
