"""Late records of a recorded stream under the slowest of its sources.

The stream's watermark is the least event time that its active sources have each
reached, less the bound, less one millisecond, and never goes back. A source counts from
its first record with an event time; one that brought nothing for ``idle_ms`` does not
count until it brings a record again. A record is judged by what came before it.

No task sees a whole stream or a whole source. Arrivals are cut into blocks of places;
what each source has reached before a block is carried to the block as one row per
source. Within a block the sources' running maxima are merged into their running minimum;
the highest watermark before a block is carried over in a second step, one row per block.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.columns import named
from tidegate.operators.lateness import CHUNK, with_earlier_top

# Workers get the functions below with the task, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NONE = np.iinfo(np.int64).min
INNER = ["__block", "__place", "__source", "__micros", "__clock", "__row"]


def flag_late_by_slowest(
    df: DataFrame,
    source_col: str,
    place_col: str,
    time_col: str,
    bound_ms: int = 3000,
    clock_col: str | None = None,
    idle_ms: int | None = None,
    chunk: int = CHUNK,
) -> DataFrame:
    """Add ``late`` to each record, replaying the stream in the order of its places.

    ``place_col`` is the record's place in the order of arrival over all sources:
    a whole number, unique and dense like offsets. ``clock_col`` is the time at which it
    arrived, needed with ``idle_ms`` only; without ``idle_ms`` every source that came
    is waited for. A record without event time or without a place is never late and moves
    nothing; records without a source are one source.
    """
    if idle_ms is not None and clock_col is None:
        raise ValueError("Idle sources are told by the time of arrival: name clock_col")
    clock = named(clock_col) if clock_col else F.lit(None).cast("timestamp")
    place = named(place_col).cast("long")
    rows = df.where(place.isNotNull()).select(
        "*",
        F.expr(f"`{place_col.replace('`', '``')}` DIV {chunk}").cast("long").alias("__block"),
        place.alias("__place"),
        named(source_col).cast("string").alias("__source"),
        _micros(named(time_col)).alias("__micros"),
        _micros(clock).alias("__clock"),
        F.lit(True).alias("__row"),
    )
    seeds = carried(rows)
    idle = None if idle_ms is None else idle_ms * 1000
    narrow = rows.select(*INNER).unionByName(seeds)
    whole = rows.unionByName(seeds, allowMissingColumns=True)

    def top_of_block(table: pa.Table) -> pa.Table:
        block, reached = table["__block"][0].as_py(), replay(table, idle)[1]
        top = int(reached[-1]) if len(reached) and reached[-1] > NONE else None
        return pa.table({"__block": pa.array([block], pa.int64()), "__top": pa.array([top], pa.int64())})

    def add_reached(table: pa.Table) -> pa.Table:
        kept, reached = replay(table, idle)
        column = pa.array(reached, pa.int64(), mask=reached == NONE)
        return kept.drop_columns(INNER[1:]).append_column("__reached", column)

    # One row per block: with blocks of 2^16 places, 15 million for 10^12 records.
    tops = narrow.groupBy("__block").applyInArrow(top_of_block, "__block bigint, __top bigint")
    before = with_earlier_top(tops.withColumn("__all", F.lit(0)), "__all", "__block", "__top", chunk, 0)
    before = before.select(F.col("__block").alias("__of"), "__earlier")
    columns = [f for f in whole.schema.fields if f.name not in INNER[1:]]
    inner = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in columns)
    merged = whole.groupBy("__block").applyInArrow(add_reached, f"{inner}, __reached bigint")
    judged = merged.join(before, F.col("__block") == F.col("__of"), "left")
    watermark = F.greatest("__reached", "__earlier") - (bound_ms + 1) * 1000
    late = F.coalesce(_micros(named(time_col)) < watermark, F.lit(False)).alias("late")
    unplaced = df.where(place.isNull()).withColumn("late", F.lit(False))
    return judged.select(*[named(c) for c in df.columns], late).unionByName(unplaced)


def _micros(moment: Column) -> Column:
    return F.unix_micros(moment.cast("timestamp"))


def carried(rows: DataFrame) -> DataFrame:
    """One row for each block and each source that came before it: what the source had reached.

    A source's state after a block holds up to the next block that has rows of it, or to
    the last block of all.
    """
    ends = rows.groupBy("__source", "__block").agg(F.max("__micros").alias("top"), F.max("__clock").alias("seen"))
    ordered = Window.partitionBy("__source").orderBy("__block")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = rows.agg(F.max("__block")).scalar()
    states = ends.select(
        "__source",
        F.max("top").over(so_far).alias("__micros"),
        F.max("seen").over(so_far).alias("__clock"),
        (F.col("__block") + 1).alias("first"),
        F.coalesce(F.lead("__block").over(ordered), last).alias("until"),
    ).where("first <= until")
    return states.select(
        F.explode(F.sequence("first", "until")).alias("__block"),
        F.lit(None).cast("long").alias("__place"),
        "__source",
        "__micros",
        "__clock",
        F.lit(False).alias("__row"),
    )


def replay(table: pa.Table, idle: int | None) -> tuple[pa.Table, np.ndarray]:
    """A block's records in order, and the event time the stream had reached before each, so far.

    ``NONE`` stands for no event time. Each source's running maximum is spread over all
    records; the least of the active ones is taken, and the highest of that so far.
    """
    own = pc.fill_null(table["__row"], False)
    rows = table.filter(own).sort_by("__place")
    seeds = table.filter(pc.invert(own))
    reached = np.full(len(rows), np.iinfo(np.int64).max)
    clock = _numbers(rows["__clock"])
    moments = _numbers(rows["__micros"])
    sources = pa.chunked_array([*rows["__source"].chunks, *seeds["__source"].chunks], pa.string())
    codes = sources.combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
    of_row, of_seed = codes[: len(rows)], codes[len(rows) :]
    seed_top, seed_seen = _numbers(seeds["__micros"]), _numbers(seeds["__clock"])
    for source in np.unique(codes):
        mine, carry = of_row == source, np.flatnonzero(of_seed == source)
        start = (seed_top[carry[0]], seed_seen[carry[0]]) if len(carry) else (NONE, NONE)
        top = np.maximum.accumulate(np.concatenate([[start[0]], moments[mine]]))
        before = np.cumsum(mine) - mine
        state = top[before]
        active = state > NONE
        if idle is not None:
            seen = np.maximum.accumulate(np.concatenate([[start[1]], clock[mine]]))[before]
            active &= (seen > NONE) & (seen >= clock - idle)
        np.minimum(reached, state, out=reached, where=active)
    reached[reached == np.iinfo(np.int64).max] = NONE
    return rows, np.maximum.accumulate(reached) if len(reached) else reached


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    return pc.fill_null(column, int(NONE)).combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64)
