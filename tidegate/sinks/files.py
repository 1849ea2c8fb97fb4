"""File writes: Parquet, CSV, JSON and ORC behind one call."""

from __future__ import annotations

from collections.abc import Mapping
from os import PathLike, fspath

from pyspark.sql import DataFrame

from tidegate.errors import ConnectorError
from tidegate.sources.files import FILE_TYPES


def write_file(
    df: DataFrame,
    file_path: str | PathLike,
    file_type: str = "parquet",
    write_mode: str = "overwrite",
    write_props: Mapping[str, object] | None = None,
) -> None:
    """Write a dataset; every entry of ``write_props`` becomes a writer option.

    Each task writes its own files and they appear when the job commits, so a lost
    executor costs a retry and leaves no double rows. ``maxRecordsPerFile`` bounds
    files that cannot be split on reading, such as multi-line CSV.
    """
    if file_type not in FILE_TYPES:
        raise ValueError(f"No writer for {file_type!r}; there is one for {FILE_TYPES}")
    writer = df.write.format(file_type).mode(write_mode).options(**(write_props or {}))
    try:
        writer.save(fspath(file_path))
    except Exception as error:
        raise ConnectorError(f"Writing {file_type} at {file_path}: {error}") from error
