"""What the operators share: picking columns, cutting words, storing intermediate tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.workspace import fresh_folder

#: Words of the shingle operators end at ASCII white space only.
SPACE = r"[ \t-\r]+"


def fields(df: DataFrame, *names: str) -> DataFrame:
    """Exactly the columns ``names``, found by position.

    Other columns are left out, whatever they are called: a second ``text`` or a
    ``TEXT`` beside ``text`` makes no reference ambiguous. The first exact match
    counts, else the first that differs in case only.
    """
    lower = [c.lower() for c in df.columns]
    at = [df.columns.index(n) if n in df.columns else lower.index(n.lower()) for n in names]
    placed = df.toDF(*[f"_{i}" for i in range(len(lower))])
    return placed.select(*[F.col(f"_{i}").alias(n) for i, n in zip(at, names, strict=True)])


def words(text: Column, separator: str = SPACE) -> Column:
    """The words between runs of ``separator``; null and empty texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separator), "")


def indexes(size: Column, window: int = 1) -> Column:
    """0, 1, ... up to the last start of a window of that many items; maybe empty."""
    last = size - window
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df``, written once to the folder that all executors share and read back.

    This cuts the lineage: a lost executor costs a re-read, not a second run.
    """
    spark = df.sparkSession
    path = fresh_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hash_sample(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """At most ``n`` rows, in the order of a hash of their keys; ``df`` is cheap to count.

    Rows are thinned by that hash first, to about 2 n, so that few reach the last step
    however many tasks there are.
    """
    total, span = df.count(), 1 << 30
    place = F.pmod(F.xxhash64(*keys), F.lit(span))
    if total > 2 * n:
        df = df.where(place < int(span * 2 * n / total))
    return df.orderBy(place, *keys).limit(n)
