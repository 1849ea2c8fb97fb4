"""Late records of a live stream, split off batch by batch.

Spark's own watermark drops rows only inside stateful operators, by whole windows
and without handing them over. Here each micro-batch is compared with the watermark
that the batches before it left: an event time they reached, less the bound, less one
millisecond. On-time, late and malformed rows are written in one job.
"""

from __future__ import annotations

import time
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegate.columns import named
from tidegate.operators.lateness import is_late
from tidegate.streaming.writers import TRIGGER

ON_TIME, LATE, MALFORMED = "on_time", "late", "malformed"
ROUTES = 3
#: So many batches lie in one folder ``span=<batch_id // SPAN>``.
SPAN = 1000
REACHED = "batch_id LONG, micros LONG"
SOURCES = "source STRING, micros LONG, seen_ms LONG"


def split_late_stream(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    time_col: str = "txn_timestamp",
    bound_ms: int = 3000,
    source_col: str | None = None,
    idle_ms: int | None = 5000,
    file_type: str = "parquet",
    columns: list[str] | None = None,
    trigger: dict | None = None,
    forget_ms: int | None = None,
) -> StreamingQuery:
    """Write every row under ``path/span=<n // SPAN>/batch_id=<n>/route=<on_time|late|malformed>``.

    Each batch overwrites its own folder and the event time it starts from is kept
    under the checkpoint, so a batch that is run again after a failure splits the
    same way and leaves no double rows. A row without event time is malformed.
    ``columns`` are the ones to write, all by default; text files take one. A stream
    that reads the result while it is written may see a repeated batch's files twice.

    The event time reached is the highest one of all rows, which the write job itself
    observes, so a batch is read once. With ``source_col`` (a topic's partition) it is
    the one the slowest source has reached; a source that brought nothing for
    ``idle_ms`` is not waited for, and ``None`` waits for every source seen so far.
    Batches are then held on the executors for the second job, one row per source. A
    source that brought nothing for ``forget_ms`` is dropped from the state, as if it
    had never come; by default none is.

    ``merge_spans`` brings the small files of spans that are over into large ones.
    """
    spark = rows.sparkSession
    state = f"{checkpoint.rstrip('/')}/event-time"
    last: dict[int, int | None] = {}  # this run's newest batch; only a restart reads the file

    def split(batch: DataFrame, batch_id: int) -> None:
        # A task keeps a file open per route, where it would else sort its rows by route.
        batch.sparkSession.conf.set("spark.sql.maxConcurrentOutputFileWriters", ROUTES)
        before = batch_id - 1
        reached = last[before] if before in last else reached_before(spark, state, batch_id)
        highest = F.timestamp_micros(F.lit(reached).cast("long"))
        route = (
            F.when(F.col(time_col).isNull(), MALFORMED)
            .when(is_late(F.col(time_col), highest, bound_ms), LATE)
            .otherwise(ON_TIME)
        )
        if source_col is None:
            newest = write(batch.withColumn("route", route), batch_id)
        else:
            batch.persist()
            try:
                write(batch.withColumn("route", route), batch_id)
                tops = batch.groupBy(named(source_col).cast("string").alias("source")).agg(
                    F.max(F.unix_micros(time_col)).alias("micros")
                )
                newest = slowest_source(spark, state, batch_id, tops, idle_ms, forget_ms)
            finally:
                batch.unpersist()
        reached = max((m for m in (reached, newest) if m is not None), default=None)
        keep_reached(spark, state, batch_id, reached)
        last.clear()
        last[batch_id] = reached

    def write(routed: DataFrame, batch_id: int) -> int | None:
        seen = Observation()
        routed = routed.observe(seen, F.max(F.unix_micros(time_col)).alias("micros"))
        if columns is not None:
            routed = routed.select(*columns, "route")
        writer = routed.write.mode("overwrite").partitionBy("route").format(file_type)
        writer.save(f"{path.rstrip('/')}/span={batch_id // SPAN}/batch_id={batch_id}")
        return seen.get["micros"]

    writer = rows.writeStream.foreachBatch(split).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or TRIGGER)).start()


# State lives in two slots that take turns: a batch reads one and writes the other, so
# the slot it starts from is still there if it has to be run again.


def reached_before(spark: SparkSession, state: str, batch_id: int) -> int | None:
    """The event time reached before ``batch_id``, in microseconds."""
    if batch_id == 0:
        return None
    kept = spark.read.schema(REACHED).json(_slot(state, "reached", batch_id - 1)).first()
    if kept is None or kept["batch_id"] != batch_id - 1:
        raise RuntimeError(f"No event-time state for batch {batch_id - 1} under {state}")
    return kept["micros"]


def keep_reached(spark: SparkSession, state: str, batch_id: int, micros: int | None) -> None:
    """Keep the event time reached with ``batch_id``."""
    kept = spark.range(0, 1, 1, 1).select(
        F.lit(batch_id).alias("batch_id"), F.lit(micros).cast("long").alias("micros")
    )
    kept.write.mode("overwrite").json(_slot(state, "reached", batch_id))


def slowest_source(
    spark: SparkSession,
    state: str,
    batch_id: int,
    tops: DataFrame,
    idle_ms: int | None,
    forget_ms: int | None = None,
) -> int | None:
    """Keep how far each source has come with ``batch_id``; give the least of the active."""
    now_ms = int(time.time() * 1000)
    known = tops.withColumn("seen_ms", F.lit(now_ms))
    if batch_id > 0:
        known = known.unionByName(
            spark.read.schema(SOURCES).json(_slot(state, "sources", batch_id - 1))
        )
    merged = known.groupBy("source").agg(
        F.max("micros").alias("micros"), F.max("seen_ms").alias("seen_ms")
    )
    if forget_ms is not None:
        merged = merged.where(F.col("seen_ms") >= now_ms - forget_ms)
    active = F.lit(True) if idle_ms is None else F.col("seen_ms") >= now_ms - idle_ms
    seen = Observation()
    observed = merged.observe(seen, F.min(F.when(active, F.col("micros"))).alias("micros"))
    observed.coalesce(1).write.mode("overwrite").json(_slot(state, "sources", batch_id))
    return seen.get["micros"]


def merge_spans(
    spark: SparkSession, path: str, archive: str, before_batch: int, schema: str, file_type: str = "parquet"
) -> list[int]:
    """Copy the spans that ended before ``before_batch`` into large files under ``archive``.

    ``schema`` is that of the written rows with batch_id and route. A span is entered in
    the archive's list only when its copy is complete, and copied anew until then, so a
    stop midway loses nothing: ``read_spans`` goes by the list. Give the id of a batch
    that has been committed. The small files are left to the storage's own expiry.
    Returns the spans copied now.
    """
    done = set(merged_spans(spark, archive))
    copied = []
    for span in range(before_batch // SPAN):
        if span in done:
            continue
        rows = _routed(spark, f"{path.rstrip('/')}/span={span}", schema, file_type)
        target = f"{archive.rstrip('/')}/rows/span={span}"
        large = rows.hint("rebalance", "route")
        large.write.mode("overwrite").partitionBy("route").format("parquet").save(target)
        entry = spark.range(0, 1, 1, 1).select(F.lit(span).alias("span"))
        entry.write.mode("append").json(f"{archive.rstrip('/')}/spans")
        copied.append(span)
    return copied


def merged_spans(spark: SparkSession, archive: str) -> list[int]:
    """The spans whose copies are complete."""
    try:
        listed = spark.read.schema("span INT").json(f"{archive.rstrip('/')}/spans")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted(row["span"] for row in listed.distinct().collect())


def read_spans(
    spark: SparkSession, path: str, archive: str, last_batch: int, schema: str, file_type: str = "parquet"
) -> DataFrame:
    """All routed rows up to ``last_batch``: merged spans from the archive, others as written."""
    done = set(merged_spans(spark, archive))
    names = [c.split()[0] for c in schema.split(", ")]
    parts = [
        _routed(spark, f"{archive.rstrip('/')}/rows/span={span}", schema, "parquet")
        if span in done
        else _routed(spark, f"{path.rstrip('/')}/span={span}", schema, file_type)
        for span in range(last_batch // SPAN + 1)
    ]
    return reduce(DataFrame.unionByName, [part.select(*names) for part in parts])


def _routed(spark: SparkSession, folder: str, schema: str, file_type: str) -> DataFrame:
    return spark.read.schema(schema).format(file_type).load(folder)


def _slot(state: str, kind: str, batch_id: int) -> str:
    return f"{state}/{kind}-{batch_id % 2}"
