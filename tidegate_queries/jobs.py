"""Whole ingestion jobs; the sinks are read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate.errors import IngestError
from tidegate.operators.validation import NULLS, PRIMARY_KEY
from tidegate.plans import ingest, ingest_all, read_run, run_jobs
from tidegate.sources import read_file
from tidegate.workspace import fresh_folder
from tidegate_queries.registry import query, utc


def file_job(sf_dir: str, name: str, target: str, file_type: str = "parquet") -> dict:
    """The spec of a job that copies one table."""
    return {
        "src": {
            "connector_type": "local_file",
            "dataset_name": name,
            "file_type": "parquet",
            "file_path": f"{sf_dir}/{name}.parquet",
            "read_props": {"mergeSchema": False},
        },
        "target": {
            "connector_type": "local_file",
            "file_type": file_type,
            "file_path": f"{target}/{name}",
            "write_mode": "overwrite",
            "write_props": {"compression": "snappy"},
        },
    }


def both_checks(keys: list[str], required: list[str]) -> dict:
    return {
        "req_validations": {
            PRIMARY_KEY: {"cols_to_check": keys},
            NULLS: {"cols_to_check": required},
        }
    }


@query("ingest_dataset", "SELECT * FROM lineitem")
def ingest_dataset(spark, sf_dir):
    """The key check fails on this table, and all of it is loaded all the same."""
    target = fresh_folder(spark, "ingest")
    checks = both_checks(["l_orderkey", "l_linenumber"], ["l_quantity", "l_shipdate"])
    ingest(utc(spark), file_job(sf_dir, "lineitem", target), checks)
    return read_file(spark, f"{target}/lineitem")


@query(
    "ingest_report",
    """
SELECT 'primary_key_validation' AS validation_type, count(*) AS total_records,
  count(*) FILTER (n > 1) AS error_records
FROM (SELECT count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM lineitem)
UNION ALL SELECT 'null_validation', count(*), count(*) FILTER (l_returnflag IS NULL) FROM lineitem""",
)
def ingest_report(spark, sf_dir):
    """What the job counted while it loaded: rows, and rows in error, by check."""
    target = fresh_folder(spark, "ingest-report")
    checks = both_checks(["l_orderkey", "l_linenumber"], ["l_returnflag"])
    result = ingest(utc(spark), file_job(sf_dir, "lineitem", target), checks)
    rows = [(kind, total, errors) for kind, (total, errors) in result.counts.items()]
    return spark.createDataFrame(
        rows, "validation_type STRING, total_records LONG, error_records LONG"
    )


@query(
    "ingest_all_jobs",
    """
SELECT 'orders' AS dataset, * FROM orders
UNION ALL BY NAME SELECT 'customer' AS dataset, * FROM customer""",
)
def ingest_all_jobs(spark, sf_dir):
    target = fresh_folder(spark, "ingest-all")
    specs = {
        "ingest~orders": file_job(sf_dir, "orders", target, "orc"),
        "ingest~customer": file_job(sf_dir, "customer", target),
    }
    checks = {
        "ingest~orders": both_checks(["o_orderkey"], ["o_custkey", "o_orderdate"]),
        "ingest~customer": both_checks(["c_custkey"], ["c_name"]),
    }
    ingest_all(utc(spark), list(specs), specs, checks)
    orders = read_file(spark, f"{target}/orders", "orc").withColumn("dataset", F.lit("orders"))
    customers = read_file(spark, f"{target}/customer").withColumn("dataset", F.lit("customer"))
    return orders.unionByName(customers, allowMissingColumns=True)


@query(
    "ingest_run_restarted",
    """
SELECT 'orders' AS job, 'loaded' AS outcome, 1 AS attempt, (SELECT count(*) FROM orders) AS "rows",
  (SELECT count(*) FROM orders) AS loaded
UNION ALL SELECT 'customer', 'loaded', 2, (SELECT count(*) FROM customer), (SELECT count(*) FROM customer)""",
)
def ingest_run_restarted(spark, sf_dir):
    """One of two jobs fails; run again, the run loads that one only. Sinks append, so a second load would show."""
    folder = fresh_folder(utc(spark), "ingest-run")
    keys = {"orders": "o_orderkey", "customer": "c_custkey"}
    specs = {name: file_job(sf_dir, name, folder) for name in keys}
    for spec in specs.values():
        spec["target"]["write_mode"] = "append"
    checks = {name: both_checks([key], [key]) for name, key in keys.items()}
    broken = {**specs, "customer": file_job(f"{folder}/nowhere", "customer", folder)}
    try:
        run_jobs(spark, "nightly", f"{folder}/ledger", list(specs), broken, checks)
    except IngestError as error:
        if error.failed != ["customer"]:
            raise
    run_jobs(spark, "nightly", f"{folder}/ledger", list(specs), specs, checks)
    loaded = [read_file(spark, f"{folder}/{name}").agg(F.count("*").alias("loaded")).withColumn("of", F.lit(name)) for name in keys]
    counts = loaded[0].unionByName(loaded[1])
    entries = read_run(spark, f"{folder}/ledger", "nightly")
    return entries.join(counts, F.col("job") == F.col("of")).select("job", "outcome", "attempt", "rows", "loaded")
