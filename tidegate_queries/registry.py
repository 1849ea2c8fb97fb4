"""Where queries register themselves, and how they reach the tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.sources import read_file

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with the SQL that gives the same rows."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def utc(spark: SparkSession) -> SparkSession:
    """The session, in UTC: the tables' timestamps have no zone and are taken as such."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the tables."""
    return read_file(utc(spark), f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str, **options: str) -> DataFrame:
    """The same table as a stream over its files.

    A stream's path must be a folder or a pattern; the pattern used here matches the
    table's own name only, whether that is one file or a folder of them.
    """
    schema = table(spark, sf_dir, name).schema
    reader = spark.readStream.schema(schema).options(**options)
    return reader.parquet(f"{sf_dir}/{name[:-1]}[{name[-1]}].parquet")


def goods(events: DataFrame) -> DataFrame:
    """Events in the shape of the sample topic's records, batch or stream."""
    return events.select(
        "event_id",
        F.col("user_id").cast("string").alias("key"),
        F.col("event_type").alias("item"),
        (F.col("user_id") % 6).cast("string").alias("retailer"),
        F.col("value").cast("decimal(10,2)").alias("price"),
        F.col("ts").cast("timestamp").alias("txn_timestamp"),
    )


# The same in SQL.
GOODS = """(SELECT event_id, user_id::VARCHAR AS key, event_type AS item,
  (user_id % 6)::VARCHAR AS retailer, value::DECIMAL(10,2) AS price, ts AS txn_timestamp
  FROM events)"""
