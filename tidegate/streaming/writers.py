"""File sinks for streams; each checkpointed, so a restart repeats and loses no row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegate.columns import named

FILES_PER_PARTITION = 1
TRIGGER = {"processingTime": "500 milliseconds"}


def write_windows_csv(
    windows: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: tuple[str, ...] = ("window_start",),
    files_per_partition: int | None = FILES_PER_PARTITION,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append finished windows to CSV, one folder for each value of ``partition_by``.

    The groups of a window lie in all shuffle partitions, and each of those would leave
    a file in the folder. So a batch's rows of a folder are brought into
    ``files_per_partition`` tasks before the write, each of which leaves one file at most.
    A batch's rows of a window are its groups, so one file is the default; take more for
    windows with millions of groups, and ``None``, which leaves them spread, for more yet. Pass
    no ``partition_by`` for one flat folder, as short windows make very many.
    """
    if partition_by and files_per_partition:
        others = [c for c in windows.columns if c not in partition_by]
        share = F.pmod(F.xxhash64(*[named(c) for c in others]), F.lit(files_per_partition))
        windows = windows.repartition(*[named(c) for c in partition_by], share)
    writer = windows.writeStream.format("csv").outputMode("append")
    return _start(writer.partitionBy(*partition_by), path, checkpoint, trigger)


def write_text_stream(
    lines: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append the ``value`` column as lines of text."""
    writer = lines.select("value").writeStream.format("text").outputMode("append")
    return _start(writer, path, checkpoint, trigger)


def write_parquet_stream(
    rows: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append rows as Parquet."""
    writer = rows.writeStream.format("parquet").outputMode("append")
    return _start(writer, path, checkpoint, trigger)


def _start(writer, path: str, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    options = {"path": path, "checkpointLocation": checkpoint}
    return writer.options(**options).trigger(**(trigger or TRIGGER)).start()
