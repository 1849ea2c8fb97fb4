"""Runs of many jobs with a ledger: what each job came to, and a restart of what is left.

A run has a name. When a job ends, its outcome is entered in the run's table; a restart
under the same name takes up the jobs without an entry of success only, so a job
that was loaded is not loaded again, whether others failed or the driver was lost. A driver lost
after a load and before its entry leaves that job to be run once more: its sink should
then overwrite, not append.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.errors import IngestError
from tidegate.plans.ingest import PHASES, IngestResult, ingest

logger = logging.getLogger(__name__)

LOADED, FAILED = "loaded", "failed"
SCHEMA = (
    "job STRING, outcome STRING, attempt INT, error STRING, rows LONG, "
    "rows_in_error MAP<STRING, LONG>, started_at TIMESTAMP, ended_at TIMESTAMP"
)


def run_jobs(
    spark: SparkSession,
    run: str,
    ledger: str,
    etl_jobs: list[str],
    specs: Mapping[str, Mapping],
    checks: Mapping[str, Mapping],
    connections: Mapping[str, Mapping] | None = None,
    phases: tuple[str, ...] | list[str] = PHASES,
    at_once: int = 4,
    pools: Mapping[str, str] | None = None,
) -> dict[str, IngestResult]:
    """Run the jobs of ``run`` that the ledger does not have as loaded, ``at_once`` side by side.

    Gives the results of the jobs that ran now. Jobs do not depend on each other: all are
    tried, and if some fail the error names them and holds the outcomes; run again
    under the same name to try those. ``pools`` names a job's scheduler pool, its own name by
    default, so that under ``spark.scheduler.mode=FAIR`` a large job does not hold up the small ones.
    """
    unknown = [job for job in etl_jobs if job not in specs]
    if unknown:
        raise KeyError(f"No spec for: {', '.join(unknown)}")
    known = {row["job"]: row for row in read_run(spark, ledger, run).collect()}  # one row a job
    left = [job for job in etl_jobs if job not in known or known[job]["outcome"] != LOADED]

    @inheritable_thread_target(spark)
    def work(job: str) -> IngestResult | Exception:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", (pools or {}).get(job, job))
        started = datetime.now(timezone.utc)
        try:
            outcome: IngestResult | Exception = ingest(spark, specs[job], checks.get(job), connections, phases)
        except Exception as error:
            logger.exception("Job %s of run %s failed", job, run)
            outcome = error
        attempt = known[job]["attempt"] + 1 if job in known else 1
        _enter(spark, ledger, run, job, outcome, attempt, started)
        return outcome

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        outcomes = dict(zip(left, pool.map(work, left), strict=True))
    failed = [job for job, outcome in outcomes.items() if isinstance(outcome, Exception)]
    if failed:
        raise IngestError(failed, outcomes)
    return outcomes


def read_run(spark: SparkSession, ledger: str, run: str) -> DataFrame:
    """The last outcome of each of a run's jobs."""
    try:
        entries = spark.read.schema(SCHEMA).json(f"{_folder(ledger, run)}/*")
        last = entries.groupBy("job").agg(F.max_by(F.struct("*"), "attempt").alias("last"))
        return last.select("last.*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMA)


def _enter(spark, ledger: str, run: str, job: str, outcome, attempt: int, started: datetime) -> None:
    failed = isinstance(outcome, Exception)
    counts = {} if failed else outcome.counts
    rows = next((total for total, _ in counts.values()), None)
    errors = {kind: wrong for kind, (_, wrong) in counts.items()}
    said = f"{type(outcome).__name__}: {outcome}"[:2000] if failed else None
    entry = spark.createDataFrame(
        [(job, FAILED if failed else LOADED, attempt, said, rows, errors, started, datetime.now(timezone.utc))], SCHEMA
    )
    # An entry of its own per attempt, as an overwrite that fails would lose the one before.
    entry.coalesce(1).write.mode("overwrite").json(f"{_folder(ledger, run)}/{_plain(job)}-{attempt % 2}")


def _folder(ledger: str, run: str) -> str:
    return f"{ledger.rstrip('/')}/run={_plain(run)}"


def _plain(name: str) -> str:
    """A name that can stand in a path and is unlike all others'."""
    return "".join(c if c.isalnum() or c in "-_" else f"~{ord(c):x}~" for c in name)

