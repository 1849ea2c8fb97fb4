"""File reads: Parquet, CSV, JSON and ORC behind one call."""

from __future__ import annotations

from collections.abc import Mapping
from os import PathLike, fspath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidegate.columns import named
from tidegate.errors import ConnectorError

FILE_TYPES = ("parquet", "csv", "json", "orc")


def read_file(
    spark: SparkSession,
    file_path: str | PathLike,
    file_type: str = "parquet",
    read_props: Mapping[str, object] | None = None,
    schema: StructType | str | None = None,
) -> DataFrame:
    """Read a dataset; every entry of ``read_props`` becomes a reader option.

    Give ``schema`` for CSV and JSON of any size: without it Spark makes a pass
    over JSON to infer types, and reads every CSV column as a string.
    """
    if file_type not in FILE_TYPES:
        raise ValueError(f"No reader for {file_type!r}; there is one for {FILE_TYPES}")
    reader = spark.read.format(file_type).options(**(read_props or {}))
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.load(fspath(file_path))
    except Exception as error:
        raise ConnectorError(f"Reading {file_type} at {file_path}: {error}") from error


def preview(df: DataFrame, rows: int = 10, order_by: list[str] | None = None) -> DataFrame:
    """The first ``rows`` rows; with ``order_by`` always the same ones.

    Ordered, Spark keeps only the top rows of each task and merges those.
    """
    if order_by:
        df = df.orderBy(*[named(c) for c in order_by])
    return df.limit(rows)
