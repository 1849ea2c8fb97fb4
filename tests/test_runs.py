"""Runs of many jobs with a ledger."""

import pytest

from tests.test_ingest import ROWS, SCHEMA
from tidegate.errors import IngestError
from tidegate.plans import read_run, run_jobs, runs
from tidegate_queries.jobs import both_checks, file_job

NAMES = ["a", "b/c", "d e"]


@pytest.fixture
def specs(spark, tmp_path):
    spark.createDataFrame(ROWS, SCHEMA).write.parquet(f"{tmp_path}/in.parquet")
    jobs = {name: file_job(str(tmp_path), "in", f"{tmp_path}/out-{n}") for n, name in enumerate(NAMES)}
    for job in jobs.values():
        job["target"]["write_mode"] = "append"  # a second load would show
    return jobs


def outcomes(spark, ledger, run="r"):
    return sorted((r.job, r.outcome, r.attempt, r.rows) for r in read_run(spark, ledger, run).collect())


def loaded(spark, tmp_path, n):
    return spark.read.parquet(f"{tmp_path}/out-{n}/in").count()


def test_a_restart_runs_the_failed_jobs_only(spark, tmp_path, specs):
    ledger = f"{tmp_path}/ledger"
    checks = {name: both_checks(["product_id"], ["item"]) for name in NAMES}
    assert outcomes(spark, ledger) == []
    bad = {**specs, "b/c": {**specs["b/c"], "src": {**specs["b/c"]["src"], "file_path": f"{tmp_path}/none"}}}
    for attempt in (1, 2):  # the second finds the one still broken
        with pytest.raises(IngestError) as error:
            run_jobs(spark, "r", ledger, NAMES, bad, checks)
        assert error.value.failed == ["b/c"]
        assert set(error.value.outcomes) == (set(NAMES) if attempt == 1 else {"b/c"})
        assert outcomes(spark, ledger) == [
            ("a", "loaded", 1, 3), ("b/c", "failed", attempt, None), ("d e", "loaded", 1, 3)
        ]
    said = {r.job: (r.error, r.rows_in_error) for r in read_run(spark, ledger, "r").collect()}
    assert "ConnectorError" in said["b/c"][0] and said["a"][0] is None
    assert said["a"][1] == {"primary_key_validation": 2, "null_validation": 1}
    assert set(run_jobs(spark, "r", ledger, NAMES, specs, checks)) == {"b/c"}
    assert run_jobs(spark, "r", ledger, NAMES, specs, checks) == {}
    assert [loaded(spark, tmp_path, n) for n in range(3)] == [3, 3, 3]
    assert set(run_jobs(spark, "r 2", ledger, NAMES[:1], specs, checks)) == {"a"}  # another run
    assert loaded(spark, tmp_path, 0) == 6
    with pytest.raises(KeyError):
        run_jobs(spark, "r", ledger, ["x"], specs, checks)


def test_jobs_run_in_pools_of_their_own(spark, tmp_path, specs, monkeypatch):
    seen = {}

    def ingest(spark, spec, *others):
        seen[spec["target"]["file_path"]] = spark.sparkContext.getLocalProperty("spark.scheduler.pool")
        raise RuntimeError("stop")

    monkeypatch.setattr(runs, "ingest", ingest)
    with pytest.raises(IngestError):
        run_jobs(spark, "r", f"{tmp_path}/ledger", NAMES[:2], specs, {}, pools={"a": "small"})
    assert sorted(seen.values()) == ["b/c", "small"]
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None
