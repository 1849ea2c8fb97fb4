"""Messages that were sent more than once, read once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.columns import named
from tidegate.functions.wire import message_id


def drop_repeats(
    messages: DataFrame,
    within: str = "10 minutes",
    time_col: str = "timestamp",
    place_cols: tuple[str, ...] = ("topic", "partition", "offset"),
) -> DataFrame:
    """Each message of a topic's stream once, by the id in its ``headers``.

    Read the topic with ``includeHeaders``. Ids are kept until the stream's ``time_col``
    (the topic's own time of arrival) has passed them by ``within``, so state holds that much of
    the topic and a repeat is dropped if it follows within that time. A message without an
    id is no repeat of any other: its place stands for it. Which of equal messages stays is
    not told. Start the query within ``rocksdb_state``.
    """
    place = F.concat_ws(":", *[named(c).cast("string") for c in place_cols])
    known = F.coalesce(F.hex(message_id(F.col("headers"))), F.concat(F.lit("at "), place))
    timed = messages.withColumn("__id", known).withWatermark(time_col, within)
    return timed.dropDuplicatesWithinWatermark(["__id"]).drop("__id")
