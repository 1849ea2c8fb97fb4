"""Event-time tumbling windows, the same on a batch and on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.columns import named


def tumbling_aggregate(
    df: DataFrame,
    time_col: str = "txn_timestamp",
    group_col: str = "retailer",
    item_col: str = "item",
    price_col: str = "price",
    window: str = "10 seconds",
    watermark: str = "5 seconds",
) -> DataFrame:
    """Item counts and price range of each window and group, bounds as text.

    All aggregates merge, so a row costs the shuffle nothing beyond its group's
    partial result. On a stream in append mode a group comes out once, when the
    watermark passes its window's end, and rows behind that are dropped; on a batch
    the watermark has no effect and every group comes out.
    """
    grouped = (
        df.withColumnRenamed(time_col, "__time")
        .withWatermark("__time", watermark)
        .groupBy(F.window("__time", window), named(group_col).alias("__group"))
        .agg(
            F.count(named(item_col)).alias("item_count"),
            F.approx_count_distinct(named(item_col)).alias("distinct_item_count"),
            F.min(named(price_col)).alias("min_price_observed"),
            F.max(named(price_col)).alias("max_price_observed"),
        )
    )
    return grouped.select(
        F.col("window.start").cast("string").alias("window_start"),
        F.col("window.end").cast("string").alias("window_end"),
        F.col("__group").alias(group_col),
        "item_count",
        "distinct_item_count",
        "min_price_observed",
        "max_price_observed",
    )
