"""Overwrites that a failure cannot empty: versions of a dataset, and a pointer to one of them.

A load writes a folder of its own. Only when that is complete a pointer to it is added,
which is one small file. Readers go by the newest pointer, so a load that fails midway, or
a driver that is lost before the pointer is written, leaves the former version readable. Old
versions are left to the storage's own expiry.
"""

from __future__ import annotations

from collections.abc import Mapping
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidegate.errors import ConnectorError
from tidegate.sinks.files import write_file
from tidegate.sources.files import read_file

POINTER = "number LONG, version STRING, published_at TIMESTAMP"


def publish_file(
    df: DataFrame, file_path: str, file_type: str = "parquet", write_props: Mapping[str, object] | None = None
) -> str:
    """Write ``df`` as a new version of the dataset and publish it; gives the version's name.

    ``df`` may read the dataset's current version. Two loads at the same time both write
    their versions; the second to publish is an error, and its version is not seen.
    """
    spark = df.sparkSession
    before = _newest(spark, file_path)
    version = uuid4().hex
    write_file(df, _folder(file_path, version), file_type, "error", write_props)
    after = _newest(spark, file_path)
    if after != before:
        raise ConnectorError(f"Another load published a version of {file_path} meanwhile")
    number = 0 if before is None else before["number"] + 1
    pointer = spark.range(0, 1, 1, 1).select(
        F.lit(number).cast("long").alias("number"),
        F.lit(version).alias("version"),
        F.current_timestamp().alias("published_at"),
    )
    pointer.write.mode("error").json(f"{_pointers(file_path)}/{number}")
    return version


def read_published(
    spark: SparkSession,
    file_path: str,
    file_type: str = "parquet",
    read_props: Mapping[str, object] | None = None,
    schema: StructType | str | None = None,
) -> DataFrame:
    """The version published last; the frame goes on reading it when another one is published."""
    pointer = _newest(spark, file_path)
    if pointer is None:
        raise ConnectorError(f"No version of {file_path} has been published")
    return read_file(spark, _folder(file_path, pointer["version"]), file_type, read_props, schema)


def published_versions(spark: SparkSession, file_path: str) -> DataFrame:
    """``number``, ``version`` and ``published_at`` of every version that was published."""
    try:
        return spark.read.schema(POINTER).json(f"{_pointers(file_path)}/*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], POINTER)


def _newest(spark: SparkSession, file_path: str):
    return published_versions(spark, file_path).orderBy(F.desc("number")).first()


def _folder(file_path: str, version: str) -> str:
    return f"{file_path.rstrip('/')}/versions/{version}"


def _pointers(file_path: str) -> str:
    return f"{file_path.rstrip('/')}/pointers"
