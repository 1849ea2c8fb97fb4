"""Folders for intermediate results that every executor can reach."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new folder under the shared one the cluster names in ``spark.checkpoint.dir``.

    Where that is unset a local session gets a temporary folder; on a cluster a
    folder of one machine would lose data, so there it is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("Set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="tidegate-")
    return f"{shared.rstrip('/')}/tidegate/{label}-{uuid4().hex}"
