"""Ingestion jobs: read a dataset, check it, write it."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidegate.columns import any_null
from tidegate.errors import IngestError
from tidegate.operators.validation import NULLS, PRIMARY_KEY, ValidationSuite, validate
from tidegate.plans.connectors import connector

PHASES = ("extraction", "validation", "load")

logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class IngestResult:
    """What a job did.

    ``passed`` has one entry for each check that was run, and so has ``counts``: the
    dataset's rows, and how many of them are in error.
    """

    dataset: str | None
    df: DataFrame
    suite: ValidationSuite | None
    passed: dict[str, bool]
    counts: dict[str, tuple[int, int]] = field(default_factory=dict)


def ingest(
    spark: SparkSession,
    spec: Mapping[str, Mapping],
    checks: Mapping[str, Mapping] | None = None,
    connections: Mapping[str, Mapping] | None = None,
    phases: tuple[str, ...] | list[str] = PHASES,
) -> IngestResult:
    """Run one job: ``spec`` has ``src`` and ``target``, ``checks`` has ``req_validations``.

    Checks are advisory: a failed one is logged and returned, and all rows are
    loaded. Rows are counted, and nulls looked for, while they are loaded; only the key
    check has a pass of its own, over the key columns. Keys in error are never brought to
    the driver: they stay in the suite's lazy frames, and where ``checks`` has a
    ``record_level_target`` (the spec of a sink) executors write them there.
    """
    if "extraction" not in phases or "load" not in phases:
        raise ValueError("A job without extraction or load moves nothing: list both phases")
    source, sink = connector("source", spec["src"]), connector("sink", spec["target"])
    dataset = spec["src"].get("dataset_name")
    df = source.read(spark, connections)
    if "validation" not in phases:
        sink.write(df, connections)
        return IngestResult(dataset, df, None, {})
    suite, required = plan_checks(df, checks), checks["req_validations"]
    seen = Observation()
    missing = any_null(required[NULLS]["cols_to_check"]) if NULLS in required else F.lit(False)
    sink.write(
        df.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(missing).alias(NULLS)),
        connections,
    )
    loaded = seen.get
    counts = {}
    for kind in suite.results:
        if kind == NULLS:
            counts[kind] = (loaded["rows"], loaded[NULLS])
        else:
            row = suite.results[kind].dataset_level.first()
            counts[kind] = (row["total_records"], row["error_records"])
        total, errors = counts[kind]
        level = logging.WARNING if errors else logging.INFO
        said = "failed" if errors else "passed"
        logger.log(level, "%s of %s: %s, %d of %d rows in error", kind, dataset, said, errors, total)
    if "record_level_target" in checks:
        frames = [result.record_level for result in suite.results.values()]
        connector("sink", checks["record_level_target"]).write(
            reduce(DataFrame.unionByName, frames), connections
        )
    passed = {kind: errors == 0 for kind, (_, errors) in counts.items()}
    return IngestResult(dataset, df, suite, passed, counts)


def plan_checks(df: DataFrame, checks: Mapping[str, Mapping] | None) -> ValidationSuite:
    """The checks a job's config lists, in its order.

    ``expect_unique`` beside the key check's ``cols_to_check`` is for nearly unique keys.
    """
    if not checks or not checks.get("req_validations"):
        raise ValueError("The validation phase needs req_validations")
    required = checks["req_validations"]
    columns = {kind: list(setting["cols_to_check"]) for kind, setting in required.items()}
    keys = columns.get(PRIMARY_KEY) or list(checks.get("primary_key_cols", []))
    expect_unique = bool(required.get(PRIMARY_KEY, {}).get("expect_unique"))
    return validate(df, list(required), keys, columns.get(NULLS), expect_unique)


def ingest_all(
    spark: SparkSession,
    etl_jobs: list[str],
    specs: Mapping[str, Mapping],
    checks: Mapping[str, Mapping],
    connections: Mapping[str, Mapping] | None = None,
    phases: tuple[str, ...] | list[str] = PHASES,
    at_once: int = 4,
) -> dict[str, IngestResult]:
    """Run the listed jobs on one session, ``at_once`` of them side by side.

    Jobs do not depend on each other: all are run, and if some fail the error names
    them and holds every outcome.
    """
    unknown = [job for job in etl_jobs if job not in specs]
    if unknown:
        raise KeyError(f"No spec for: {', '.join(unknown)}")

    @inheritable_thread_target(spark)
    def run(job: str) -> IngestResult | Exception:
        try:
            return ingest(spark, specs[job], checks.get(job), connections, phases)
        except Exception as error:
            logger.exception("Job %s failed", job)
            return error

    with ThreadPoolExecutor(max_workers=at_once) as pool:
        outcomes = dict(zip(etl_jobs, pool.map(run, etl_jobs), strict=True))
    failed = [job for job, outcome in outcomes.items() if isinstance(outcome, Exception)]
    if failed:
        raise IngestError(failed, outcomes)
    return outcomes
