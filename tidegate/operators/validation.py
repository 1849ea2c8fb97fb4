"""Key and null checks over a dataset.

Each check has a dataset-level row (passed, counts) and record-level rows (the
keys in error). Both are lazy frames. The dataset-level rows of all checks come
from one scan of the key and required columns: rows are counted per key, which
Spark does before and after the shuffle, so a key that holds a third of the data
arrives as one partial count per task.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.columns import any_null, json_key, named
from tidegate.operators.unique_keys import Candidates, candidates

PRIMARY_KEY = "primary_key_validation"
NULLS = "null_validation"


@dataclass(frozen=True)
class ValidationResult:
    """What one check found; ``record_level`` is empty when the data is clean."""

    kind: str
    dataset_level: DataFrame
    record_level: DataFrame

    def passed(self) -> bool:
        """Run the dataset-level check and tell whether it passed."""
        return self.dataset_level.first()["passed"]


@dataclass(frozen=True)
class ValidationSuite:
    """The checks of one dataset, in the order they were asked for."""

    dataset_level: DataFrame
    results: dict[str, ValidationResult]

    def passed(self) -> dict[str, bool]:
        """Run all checks in one job; one entry for each of them."""
        return {row["validation_type"]: row["passed"] for row in self.dataset_level.collect()}


def validate(
    df: DataFrame,
    kinds: list[str],
    primary_key_cols: list[str] | None = None,
    non_nullable_cols: list[str] | None = None,
    expect_unique: bool = False,
) -> ValidationSuite:
    """Plan the checks in ``kinds``; nothing runs until a frame is used.

    With ``expect_unique`` one pass over the keys runs now and leaves the rows whose key may
    repeat, so that nearly unique keys are not shuffled; with few distinct keys the usual
    way is faster. The rows that come out are the same.
    """
    _check_arguments(kinds, primary_key_cols, non_nullable_cols)
    run_ts = F.lit(datetime.now())
    suspects = candidates(df, primary_key_cols) if expect_unique and PRIMARY_KEY in kinds else None
    keyed = df if suspects is None else suspects.rows
    records = {
        PRIMARY_KEY: lambda: duplicate_keys(keyed, primary_key_cols, run_ts),
        NULLS: lambda: null_rows(df, primary_key_cols, non_nullable_cols, run_ts),
    }
    results = {
        kind: ValidationResult(
            kind,
            summary(df, [kind], primary_key_cols, non_nullable_cols, run_ts, suspects),
            records[kind](),
        )
        for kind in kinds
    }
    together = summary(df, kinds, primary_key_cols, non_nullable_cols, run_ts, suspects)
    return ValidationSuite(together, results)


def duplicate_keys(df: DataFrame, keys: list[str], run_ts: Column | None = None) -> DataFrame:
    """One row for each key held by several rows; null keys count as equal.

    ``expected_count`` is 0 by contract: it is the count of rows in error, not the
    count of rows a key should have.
    """
    groups = _rows_per_key(df, keys).where(F.col("__rows") > 1)
    return _record_level(groups, PRIMARY_KEY, keys, F.col("__rows"), run_ts)


def null_rows(
    df: DataFrame, keys: list[str], required: list[str], run_ts: Column | None = None
) -> DataFrame:
    """One row for each record that lacks at least one required value. No shuffle."""
    return _record_level(df.where(any_null(required)), NULLS, keys, F.lit(1), run_ts)


def summary(
    df: DataFrame,
    kinds: list[str],
    keys: list[str] | None = None,
    required: list[str] | None = None,
    run_ts: Column | None = None,
    suspects: Candidates | None = None,
) -> DataFrame:
    """One dataset-level row for each check, all from a single pass over ``df``.

    With ``suspects`` keys are counted over those rows only, and nulls in a pass of their own.
    """
    missing = F.count_if(any_null(required)) if NULLS in kinds else F.lit(0)
    if PRIMARY_KEY in kinds and suspects is not None:
        repeated = F.sum(F.when(F.col("__rows") > 1, F.col("__rows"))).alias(PRIMARY_KEY)
        nulls = df.agg(missing).scalar() if NULLS in kinds else F.lit(0)
        totals = _rows_per_key(suspects.rows, keys).agg(repeated)
        totals = totals.select(F.lit(suspects.total).alias("rows"), PRIMARY_KEY, nulls.alias(NULLS))
    elif PRIMARY_KEY in kinds:
        totals = _rows_per_key(df, keys, missing.alias("__missing")).agg(
            F.sum("__rows").alias("rows"),
            F.sum(F.when(F.col("__rows") > 1, F.col("__rows"))).alias(PRIMARY_KEY),
            F.sum("__missing").alias(NULLS),
        )
    else:
        totals = df.agg(F.count(F.lit(1)).alias("rows"), missing.alias(NULLS))
    return totals.select(
        F.inline(F.array(*[_dataset_level(kind, run_ts) for kind in kinds]))
    )


def row_count(df: DataFrame) -> DataFrame:
    """The dataset's row count as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias("total_records"))


def _rows_per_key(df: DataFrame, keys: list[str], *more: Column) -> DataFrame:
    return df.groupBy(*[named(k) for k in keys]).agg(F.count(F.lit(1)).alias("__rows"), *more)


def _record_level(
    rows: DataFrame, kind: str, keys: list[str], observed: Column, run_ts: Column | None
) -> DataFrame:
    return rows.select(
        F.lit(kind).alias("validation_type"),
        json_key(keys).alias("observed_record_pk"),
        F.lit(0).alias("expected_count"),
        observed.alias("observed_count"),
        (F.current_timestamp() if run_ts is None else run_ts).alias("ts"),
    )


def _dataset_level(kind: str, run_ts: Column | None) -> Column:
    errors = F.coalesce(F.col(kind), F.lit(0)).cast("long")
    return F.struct(
        F.lit(kind).alias("validation_type"),
        (errors == 0).alias("passed"),
        F.coalesce(F.col("rows"), F.lit(0)).cast("long").alias("total_records"),
        errors.alias("error_records"),
        (F.current_timestamp() if run_ts is None else run_ts).alias("ts"),
    )


def _check_arguments(kinds, keys, required) -> None:
    for kind in kinds:
        if kind not in (PRIMARY_KEY, NULLS):
            raise ValueError(f"No check is called {kind!r}")
    if not kinds:
        raise ValueError("No validation asked for")
    if not keys:
        raise ValueError("Name the key columns: both checks report by key")
    if NULLS in kinds and not required:
        raise ValueError("Name the columns in which the null check looks for nulls")
