"""The offsets that a stream's committed batches reached, in a place of their own.

A checkpoint knows them too, but in its own form, and with the checkpoint they are lost: a
text topic read anew from ``latest`` would then leave out what came in between. The ledger
lies elsewhere, can be read as a table, and gives the offsets to start from.

Progress is reported after a batch is committed. So the ledger is never ahead of the
output; a driver lost between commit and entry leaves it one batch behind, and a start
from it then repeats that batch.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

#: Entries of a query that are kept: a batch takes the place of the one that many before it.
KEPT = 16
#: What a topic's reader takes for the first offset of a partition.
EARLIEST = -2
SCHEMA = (
    "batch_id LONG, run_id STRING, source INT, description STRING, start_offset STRING, "
    "end_offset STRING, rows LONG, committed_at STRING"
)


class OffsetLedger(StreamingQueryListener):
    """Enters every committed batch of the named queries under ``path``.

    Add it to a session with ``spark.streams.addListener`` before the queries start, and give
    them names (``queryName``). Batches that moved no offset are not entered.
    """

    def __init__(self, spark: SparkSession, path: str, names: Iterable[str]):
        self.spark = spark
        self.path = path.rstrip("/")
        self.names = set(names)
        self.reached: dict[tuple[str, str], list[str | None]] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        step = event.progress
        if step.name not in self.names:
            return
        now = [source.endOffset for source in step.sources]
        run = (step.name, str(step.runId))
        if self.reached.get(run) == now or all(offset is None for offset in now):
            return
        rows = [
            (step.batchId, str(step.runId), number, source.description, source.startOffset, source.endOffset,
             source.numInputRows, step.timestamp)
            for number, source in enumerate(step.sources)
        ]
        entry = self.spark.createDataFrame(rows, SCHEMA).coalesce(1)
        entry.write.mode("overwrite").json(_slot(self.path, step.name, step.batchId))
        self.reached[run] = now

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def read_ledger(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The last ``KEPT`` entries of a query: one row for each batch and source."""
    try:
        return spark.read.schema(SCHEMA).json(f"{path.rstrip('/')}/query={name}/slot=*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMA)


def committed_offsets(spark: SparkSession, path: str, name: str, source: int = 0) -> str | None:
    """The offset which the query's last entered batch reached in a source; None without entries.

    Entries of several runs are told apart by time, as a run on a new checkpoint counts
    its batches anew.
    """
    entries = read_ledger(spark, path, name).where(F.col("source") == source)
    last = entries.orderBy(F.desc("committed_at"), F.desc("batch_id")).first()
    return None if last is None else last["end_offset"]


def starting_offsets(
    spark: SparkSession, path: str, name: str, default: str, partitions: dict[str, Iterable[int]] | None = None
) -> str:
    """Where a topic's reader should start: after the last entered batch, else at ``default``.

    A reader that is given offsets must be given those of all partitions. Name the topics'
    ``partitions``: those the ledger does not know came later and are read from their first message.
    """
    known = committed_offsets(spark, path, name)
    if known is None:
        return default
    offsets = json.loads(known)
    for topic, numbers in (partitions or {}).items():
        held = offsets.setdefault(topic, {})
        for number in numbers:
            held.setdefault(str(number), EARLIEST)
    return json.dumps(offsets, sort_keys=True)


def _slot(path: str, name: str, batch_id: int) -> str:
    return f"{path}/query={name}/slot={batch_id % KEPT}"
