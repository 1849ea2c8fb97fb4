"""Message topics as streams, through Spark's Kafka source.

The ``spark-sql-kafka`` package has to be on the session's class path.
Offsets live in the query's checkpoint: a restarted query goes on after the last
committed batch, so no consumer group commits are made.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def topic_options(
    servers: str,
    topic: str,
    *,
    starting_offsets: str | None = None,
    group_id: str | None = None,
    committed_only: bool = False,
    props: Mapping[str, object] | None = None,
) -> dict[str, object]:
    """Reader options for one topic; what is left out keeps Spark's default."""
    options: dict[str, object] = {"kafka.bootstrap.servers": servers, "subscribe": topic}
    if starting_offsets:
        options["startingOffsets"] = starting_offsets
    if group_id:
        options["kafka.group.id"] = group_id
    if committed_only:
        options["kafka.isolation.level"] = "read_committed"
    return {**options, **(props or {})}


def read_binary_topic(spark: SparkSession, servers: str, topic: str, **settings) -> DataFrame:
    """The topic's messages with ``key`` and ``value`` as bytes."""
    options = topic_options(servers, topic, **settings)
    return spark.readStream.format("kafka").options(**options).load()


def read_text_topic(
    spark: SparkSession, servers: str, topic: str, starting_offsets: str = "latest", **settings
) -> DataFrame:
    """The topic's message values as text, with the place each one was read from."""
    messages = read_binary_topic(
        spark, servers, topic, starting_offsets=starting_offsets, **settings
    )
    return messages.selectExpr("CAST(value AS STRING) AS value", "partition", "offset")
