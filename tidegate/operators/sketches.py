"""Distinct counts that can be rolled up: a sketch per window instead of a number.

A count of distinct items of an hour says nothing about the day's. A sketch of fixed size
does: sketches of hours merge to the sketch of their day without reading a row again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.columns import named

#: Sketches have 2^12 registers, some 2 KB, and a standard error of 1.04 / 64, or 1.6 %.
LOG_REGISTERS = 12


def standard_error(log_registers: int = LOG_REGISTERS) -> float:
    """The relative standard error of an estimate; under a few hundred items there is hardly any."""
    return 1.04 / 2 ** (log_registers / 2)


def sketch_windows(
    df: DataFrame,
    time_col: str,
    group_col: str,
    item_col: str,
    window: str = "1 hour",
    log_registers: int = LOG_REGISTERS,
    watermark: str | None = None,
) -> DataFrame:
    """``window_start``, the group, ``rows`` and ``items``, the sketch of the distinct items.

    Items are whole numbers, text or bytes; nulls are not counted. On a stream, give a
    ``watermark``: a window then comes out when it is over.
    """
    timed = df.withColumnRenamed(time_col, "__time")
    if watermark:
        timed = timed.withWatermark("__time", watermark)
    return (
        timed.groupBy(F.window("__time", window), named(group_col).alias("__group"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.hll_sketch_agg(named(item_col), log_registers).alias("items"),
        )
        .select(F.col("window.start").alias("window_start"), F.col("__group").alias(group_col), "rows", "items")
    )


def roll_up(sketched: DataFrame, group_col: str, window: str = "1 day") -> DataFrame:
    """The windows of ``sketch_windows`` merged into larger ones that they fit into."""
    return (
        sketched.groupBy(F.window("window_start", window), named(group_col).alias("__group"))
        .agg(F.sum("rows").alias("rows"), F.hll_union_agg("items").alias("items"))
        .select(F.col("window.start").alias("window_start"), F.col("__group").alias(group_col), "rows", "items")
    )


def with_estimate(sketched: DataFrame) -> DataFrame:
    """Replace the sketch ``items`` by ``distinct_items``, the estimated count."""
    return sketched.withColumn("distinct_items", F.hll_sketch_estimate("items")).drop("items")
