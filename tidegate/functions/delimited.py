"""The ``item|retailer|price|yyyy-MM-dd HH:mm:ss`` text layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATOR = "|"
# Reading takes one- or two-digit months, days and times; writing pads them. Spark's own
# time patterns take any number of digits and a sign, and are slower than this and a cast.
READ_TIME = r"^(?!0000)\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}\z"
WRITE_TIME = "yyyy-MM-dd HH:mm:ss"


def delimited_line(item: Column, retailer: Column, price: Column, txn_timestamp: Column) -> Column:
    """One record as a line of text."""
    return F.concat_ws(
        SEPARATOR,
        item.cast("string"),
        retailer.cast("string"),
        price.cast("string"),
        F.date_format(txn_timestamp, WRITE_TIME),
    )


def event_time(line: Column) -> Column:
    """The fourth field as a timestamp in the session's zone; null if it is not one."""
    text = _field(line, 3)
    return F.when(text.rlike(READ_TIME), text.try_cast("timestamp"))


def parse_delimited(df: DataFrame, line: str = "value") -> DataFrame:
    """Add ``item, retailer, price, txn_timestamp, event_ms`` to each line.

    A line without a readable event time gets nulls there and stays in the result,
    so one bad message does not stop the stream; the late-record operators route it.
    """
    text = F.col(line)
    stamp = event_time(text)
    return df.select(
        "*",
        _field(text, 0).alias("item"),
        _field(text, 1).alias("retailer"),
        _field(text, 2).try_cast("decimal(10,2)").alias("price"),
        stamp.alias("txn_timestamp"),
        F.unix_millis(stamp).alias("event_ms"),
    )


def _field(line: Column, position: int) -> Column:
    return F.get(F.split(line, r"\|"), position)
