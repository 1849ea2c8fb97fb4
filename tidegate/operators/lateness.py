"""Late records of a recorded stream, judged record by record.

A record is late when its event time is behind the watermark, which is the highest
event time seen before it in the same source partition, less the bound, less one
millisecond. Each source partition has its own watermark here; the minimum across
partitions is not taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidegate.columns import named

CHUNK = 1 << 16
LEVELS = 2


def is_late(event_time: Column, highest: Column, bound_ms: int) -> Column:
    """Never late: a record without event time, or before any watermark."""
    watermark = highest - F.expr(f"INTERVAL {bound_ms + 1} MILLISECOND")
    return F.coalesce(event_time < watermark, F.lit(False))


def flag_late(
    df: DataFrame,
    source_col: str,
    offset_col: str,
    time_col: str,
    bound_ms: int = 3000,
    chunk: int = CHUNK,
) -> DataFrame:
    """Add ``late`` to each record, replaying every source in offset order.

    Offsets must be unique within a source. The records are shuffled once, in groups
    of at most ``chunk``, however many of them one source holds.
    """
    replayed = with_earlier_top(df, source_col, offset_col, time_col, chunk, LEVELS)
    late = is_late(named(time_col), F.col("__earlier"), bound_ms)
    return replayed.withColumn("late", late).select(*[named(c) for c in df.columns], "late")


def with_earlier_top(
    rows: DataFrame, source_col: str, place_col: str, time_col: str, chunk: int, levels: int
) -> DataFrame:
    """Add ``__earlier``: the highest ``time_col`` at lower places of the same source.

    A running maximum over a whole source would put that source in one task. So places
    are cut into ranges of ``chunk``, and each range is led by one seed row that holds
    the maximum of the ranges before it. The seeds are a running maximum themselves,
    over one row per range, found the same way one level up; at the last level there
    is one row left for every ``chunk ** levels`` places.
    """
    source, place, moment = (named(c) for c in (source_col, place_col, time_col))
    if levels == 0:
        return rows.withColumn("__earlier", _top_before(moment, Window.partitionBy(source).orderBy(place)))
    range_col = f"__range{levels}"
    quoted = place_col.replace("`", "``")
    cut = F.expr(f"`{quoted}` DIV {chunk}").alias(range_col)
    ranges = rows.groupBy(source, cut).agg(F.max(moment).alias(time_col))
    seeds = with_earlier_top(ranges, source_col, range_col, time_col, chunk, levels - 1).select(
        source, range_col, F.col("__earlier").alias(time_col), F.lit(False).alias("__row")
    )
    led = rows.select("*", cut, F.lit(True).alias("__row")).unionByName(
        seeds, allowMissingColumns=True
    )
    earlier = Window.partitionBy(source, range_col).orderBy(F.col("__row"), place)
    led = led.withColumn("__earlier", _top_before(moment, earlier)).where("__row")
    return led.drop(range_col, "__row")


def _top_before(moment: Column, ordered: WindowSpec) -> Column:
    return F.max(moment).over(ordered.rowsBetween(Window.unboundedPreceding, -1))
