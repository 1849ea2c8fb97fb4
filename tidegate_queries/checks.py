"""Validation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate.operators.validation import (
    NULLS,
    PRIMARY_KEY,
    duplicate_keys,
    null_rows,
    row_count,
    summary,
    validate,
)
from tidegate.sources import preview
from tidegate_queries.registry import query, table

LINE_KEY = ["l_orderkey", "l_linenumber"]

PK_DUPLICATES = """
SELECT 'primary_key_validation' AS validation_type,
  to_json({'l_orderkey': l_orderkey, 'l_linenumber': l_linenumber})::VARCHAR AS observed_record_pk,
  0 AS expected_count, count(*) AS observed_count
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""


def orders_with_gaps(spark, sf_dir):
    """Orders with one priority blanked, as the tables hold no nulls."""
    blanked = F.expr("nullif(o_orderpriority, '1-URGENT')")
    return table(spark, sf_dir, "orders").withColumn("o_orderpriority", blanked)


def lines_with_gaps(spark, sf_dir):
    """Line items with the returned flag blanked."""
    blanked = F.expr("nullif(l_returnflag, 'R')")
    return table(spark, sf_dir, "lineitem").withColumn("l_returnflag", blanked)


@query("dataset_count", "SELECT count(*) AS total_records FROM lineitem")
def dataset_count(spark, sf_dir):
    return row_count(table(spark, sf_dir, "lineitem"))


@query("pk_duplicates", PK_DUPLICATES)
def pk_duplicates(spark, sf_dir):
    return duplicate_keys(table(spark, sf_dir, "lineitem"), LINE_KEY).drop("ts")


@query(
    "pk_summary",
    f"""
SELECT 'primary_key_validation' AS validation_type, coalesce(sum(observed_count), 0) = 0 AS passed,
  (SELECT count(*) FROM lineitem) AS total_records,
  coalesce(sum(observed_count), 0)::BIGINT AS error_records
FROM ({PK_DUPLICATES})""",
)
def pk_summary(spark, sf_dir):
    return summary(table(spark, sf_dir, "lineitem"), [PRIMARY_KEY], LINE_KEY).drop("ts")


@query(
    "pk_summary_unique",
    """
SELECT 'primary_key_validation' AS validation_type,
  count(*) = count(DISTINCT (conv_id, turn)) AS passed, count(*) AS total_records,
  (SELECT coalesce(sum(n), 0)::BIGINT FROM (SELECT count(*) AS n FROM conversations
   GROUP BY conv_id, turn HAVING count(*) > 1)) AS error_records
FROM conversations""",
)
def pk_summary_unique(spark, sf_dir):
    conversations = table(spark, sf_dir, "conversations")
    return summary(conversations, [PRIMARY_KEY], ["conv_id", "turn"]).drop("ts")


@query(
    "null_violations",
    """
SELECT 'null_validation' AS validation_type,
  to_json({'o_orderkey': o_orderkey})::VARCHAR AS observed_record_pk,
  0 AS expected_count, 1 AS observed_count
FROM orders WHERE nullif(o_orderpriority, '1-URGENT') IS NULL OR o_orderstatus IS NULL""",
)
def null_violations(spark, sf_dir):
    required = ["o_orderpriority", "o_orderstatus"]
    return null_rows(orders_with_gaps(spark, sf_dir), ["o_orderkey"], required).drop("ts")


@query(
    "null_summary",
    """
SELECT 'null_validation' AS validation_type,
  count(*) FILTER (nullif(o_orderpriority, '1-URGENT') IS NULL) = 0 AS passed,
  count(*) AS total_records,
  count(*) FILTER (nullif(o_orderpriority, '1-URGENT') IS NULL) AS error_records
FROM orders""",
)
def null_summary(spark, sf_dir):
    orders = orders_with_gaps(spark, sf_dir)
    return summary(orders, [NULLS], required=["o_orderpriority"]).drop("ts")


@query(
    "validation_suite",
    f"""
SELECT 'primary_key_validation' AS validation_type, coalesce(sum(observed_count), 0) = 0 AS passed,
  (SELECT count(*) FROM lineitem) AS total_records,
  coalesce(sum(observed_count), 0)::BIGINT AS error_records
FROM ({PK_DUPLICATES})
UNION ALL
SELECT 'null_validation', count(*) FILTER (nullif(l_returnflag, 'R') IS NULL) = 0, count(*),
  count(*) FILTER (nullif(l_returnflag, 'R') IS NULL)
FROM lineitem""",
)
def validation_suite(spark, sf_dir):
    lines = lines_with_gaps(spark, sf_dir)
    suite = validate(lines, [PRIMARY_KEY, NULLS], LINE_KEY, ["l_returnflag"])
    return suite.dataset_level.drop("ts")


PART_KEY = ["l_orderkey", "l_partkey"]
PART_DUPLICATES = """
SELECT to_json({'l_orderkey': l_orderkey, 'l_partkey': l_partkey})::VARCHAR AS observed_record_pk,
  count(*) AS observed_count
FROM lineitem GROUP BY l_orderkey, l_partkey HAVING count(*) > 1"""


@query("pk_duplicates_nearly_unique", PART_DUPLICATES)
def pk_duplicates_nearly_unique(spark, sf_dir):
    """Keys of which hardly any repeats: only rows of crowded hash buckets are counted by key."""
    suite = validate(table(spark, sf_dir, "lineitem"), [PRIMARY_KEY], PART_KEY, expect_unique=True)
    records = suite.results[PRIMARY_KEY].record_level
    return records.select("observed_record_pk", "observed_count")


@query(
    "validation_suite_nearly_unique",
    f"""
SELECT 'primary_key_validation' AS validation_type, coalesce(sum(observed_count), 0) = 0 AS passed,
  (SELECT count(*) FROM lineitem) AS total_records,
  coalesce(sum(observed_count), 0)::BIGINT AS error_records
FROM ({PART_DUPLICATES})
UNION ALL
SELECT 'null_validation', count(*) FILTER (nullif(l_returnflag, 'R') IS NULL) = 0, count(*),
  count(*) FILTER (nullif(l_returnflag, 'R') IS NULL)
FROM lineitem""",
)
def validation_suite_nearly_unique(spark, sf_dir):
    lines = lines_with_gaps(spark, sf_dir)
    suite = validate(lines, [PRIMARY_KEY, NULLS], PART_KEY, ["l_returnflag"], expect_unique=True)
    return suite.dataset_level.drop("ts")


@query("preview_rows", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 10")
def preview_rows(spark, sf_dir):
    return preview(table(spark, sf_dir, "orders"), 10, ["o_orderkey"])
