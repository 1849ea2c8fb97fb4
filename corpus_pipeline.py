"""The training-data pipeline: five stages over ``documents``, each one operator of ``tidegate.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
stage's result as Parquet to the shared folder and reads it back for the next, so a
lost executor repeats one stage's tasks at most. All but the last stage return the
columns of documents, in their order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm import (
    compress_quality,
    decontaminate,
    pii_boost,
    poisson_mix,
    simhash_partitions,
)
from tidegate.llm.frames import fields, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _keep(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The documents whose key is in ``keys``, each row as often as it was.

    ``keys`` has doc_id and maybe content, the xxhash64 of the text. Rows that share an
    id (those without one share null) but not the text are only told apart with content.
    """
    wanted = keys.toDF(*[f"wanted_{c}" for c in keys.columns]).distinct()
    found = fields(docs, *COLUMNS).withColumn("content", F.xxhash64("text"))
    same = [F.col(c).eqNullSafe(F.col(f"wanted_{c}")) for c in keys.columns]
    return found.join(wanted, same, "left_semi").drop("content")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents whose quality score is below the operator's threshold."""
    verdicts = compress_quality.classify(docs, _table(spark, sf_dir, "labels"), with_content=True)
    return _keep(docs, verdicts.where("predicted = 1").select("doc_id", "content"))


def _contents(docs: DataFrame) -> DataFrame:
    """(content, fingerprint) of the texts, the fingerprint as the operator returns it."""
    of_text = simhash_partitions.fingerprints(docs.select(F.xxhash64("text").alias("doc_id"), "text"))
    return of_text.select(F.col("doc_id").alias("content"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"))


def _single_group(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """``kept`` without rows whose id leads a group but whose own text is in another group."""
    leads = F.col("doc_id") == F.col("component_id")
    mixed = (
        groups.where("doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.bool_or(leads).alias("leads"), F.bool_or(~leads).alias("follows"))
        .where("leads AND follows")
        .select("doc_id")
    )
    if mixed.isEmpty():
        return kept
    inside = kept.join(mixed, "doc_id", "left_semi")
    leading = groups.where(leads).select("doc_id", "fingerprint").distinct()
    keys = leading.join(mixed, "doc_id", "left_semi").join(_contents(inside).distinct(), "fingerprint")
    outside = kept.join(mixed, "doc_id", "left_anti")
    return outside.unionByName(_keep(inside, keys.select("doc_id", "content")))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group: the one with the group's smallest doc_id.

    Of rows that repeat that doc_id one stays. A document without an id stays only
    if its whole group has none; of such a group one row stays.
    """
    groups = stored(simhash_partitions.near_duplicates(docs), "near-duplicates")
    first = groups.where("doc_id <=> component_id")
    repeated = first.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").select("doc_id")
    kept = _single_group(_keep(docs, first.select("doc_id")), groups)
    if repeated.isEmpty():
        return kept
    again = F.broadcast(repeated) if repeated.count() <= 100_000 else repeated
    again = again.select(F.col("doc_id").alias("again"))
    same = F.col("doc_id").eqNullSafe(F.col("again"))
    single = kept.join(again, same, "left_anti")
    named = kept.join(again, same, "left_semi").where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    nameless = kept.where("doc_id IS NULL")
    of_text = simhash_partitions.fingerprints(nameless.select(F.xxhash64("text").alias("doc_id"), "text"))
    grouped = groups.where("component_id IS NULL").select("fingerprint").distinct()
    one = (
        of_text.withColumn("fingerprint", F.lpad(F.lower(F.hex("fp")), 16, "0"))
        .join(grouped, "fingerprint", "left_semi")
        .groupBy("fingerprint")
        .agg(F.min("doc_id").alias("content"))
    )
    unnamed = nameless.join(one, F.xxhash64("text") == F.col("content"), "left_semi").dropDuplicates(["text"])
    return single.unionByName(named).unionByName(unnamed)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the contamination rule marks."""
    verdicts = decontaminate.contamination(docs, _table(spark, sf_dir, "benchmark"), with_content=True)
    return _keep(docs, verdicts.where("NOT contaminated").select("doc_id", "content"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind in brackets; n_chars follows the new text."""
    return pii_boost.redact(docs, COLUMNS).select(
        "doc_id",
        "text",
        "lang",
        "source",
        F.coalesce(F.char_length("text").cast("long"), F.col("n_chars")).alias("n_chars"),
    )


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that sources meet their target weights, in random order."""
    return poisson_mix.mix(fields(docs, *COLUMNS))


STAGES = [
    ("quality classifier", quality_classifier),
    ("simhash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("personal data", personal_data),
    ("source mixing", source_mixing),
]

#: The classifier and the SimHash are not expressible in SQL; tests use plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
