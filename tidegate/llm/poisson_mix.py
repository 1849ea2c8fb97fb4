"""Mixing sources to target weights by Poisson replication.

Each source has a mean repetition rate: draws x weight / size. Each document's
count comes from inverting the Poisson distribution of its source's rate at a
uniform number that is a hash of seed and doc_id, so a repeat of the job, or of
a lost task, gives the same counts. The document is exploded by its count and
the copies are dealt and sorted by another hash: a global shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.frames import fields, stored

SEED = 20
#: Default weights are size ** TEMPERATURE: rare sources gain, common ones lose.
TEMPERATURE = 0.5
#: Higher rates are split into several draws, as exp(-rate) must not vanish.
RATE_PER_DRAW = 500.0
#: Above so many sources their rates are joined by shuffle instead of broadcast.
BROADCAST_SOURCES = 10_000


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the hash of the parts; 52 bits."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / float(1 << 52)


def poisson_cdf(rate: Column) -> Column:
    """P(X <= 0), P(X <= 1), ... far enough that the rest is below 2 ** -52."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")
    first = F.exp(-rate)
    start = F.struct(first.alias("p"), F.array(first).alias("cdf"))
    walked = F.aggregate(
        F.sequence(F.lit(1), last),
        start,
        lambda acc, k: F.struct(
            (acc["p"] * rate / k).alias("p"),
            F.concat(
                acc["cdf"], F.array(F.element_at(acc["cdf"], -1) + acc["p"] * rate / k)
            ).alias("cdf"),
        ),
    )
    return walked["cdf"]


def source_rates(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    temperature: float = TEMPERATURE,
    draws: int | None = None,
) -> DataFrame:
    """(source, n, rate): each source's size and mean repetition rate.

    ``weights`` name targets by source; those left out get none (rate 0). Without
    it the weight is size ** temperature. ``draws`` is the expected number of
    copies, by default the number of documents. A null source is a source.
    """
    sizes = fields(docs, "source").groupBy("source").agg(F.count("*").alias("n"))
    if weights is None:
        weight = F.pow(F.col("n").cast("double"), F.lit(temperature))
    else:
        weight = F.lit(0.0)
        for name, value in weights.items():
            weight = F.when(F.col("source").eqNullSafe(name), float(value)).otherwise(weight)
    weighted = stored(sizes.withColumn("weight", weight), "source-sizes")
    total = weighted.agg(F.sum("weight"), F.sum("n")).first()
    wanted = float((total[1] or 0) if draws is None else draws)
    share = wanted / total[0] if total[0] else 0.0
    return weighted.select("source", "n", (F.col("weight") * share / F.col("n")).alias("rate"))


def mix(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    temperature: float = TEMPERATURE,
    draws: int | None = None,
    seed: int = SEED,
    broadcast_sources: int = BROADCAST_SOURCES,
) -> DataFrame:
    """The copies drawn, in random order: all columns of ``docs``, ``copy`` and ``shuffle_key``.

    A document with count k comes k times, with copy 0 .. k - 1; with count 0 it
    does not come. Repeated rows get equal counts and each is copied; a row without
    doc_id is known by a hash of all its columns instead. Copies with one shuffle key
    (of repeated rows) are dealt by their place in the input as well, so no task gets them all.
    Input columns called copy or shuffle_key, in any case, are replaced. An empty table
    gives an empty result. ``weights`` is a small dict; texts, null or long, are carried along.
    """
    rates = stored(
        source_rates(docs, weights, temperature, draws).select(
            F.col("source").alias("of_source"),
            F.greatest(F.lit(1), F.ceil(F.col("rate") / RATE_PER_DRAW)).cast("int").alias("parts"),
            "rate",
        )
        .select("of_source", "parts", poisson_cdf(F.col("rate") / F.col("parts")).alias("cdf")),
        "source-rates",
    )
    if rates.count() <= broadcast_sources:
        rates = F.broadcast(rates)
    own = {"copy", "shuffle_key"}
    kept = [c for c in docs.columns if c.lower() not in own]
    place = {c: f"_{i}" for i, c in reversed(list(enumerate(docs.columns)))}
    lower = [c.lower() for c in docs.columns]
    doc_id, source = (F.col(f"_{lower.index(n)}") for n in ("doc_id", "source"))
    whole = F.to_json(F.struct(*[F.col(p) for p in place.values()]))
    nameless = F.concat(F.lit("row "), F.xxhash64(whole).cast("string"))
    known = F.coalesce(doc_id.cast("string"), nameless)
    drawn = F.aggregate(
        F.sequence(F.lit(1), F.col("parts")),
        F.lit(0),
        lambda total, part: total
        + F.size(F.filter("cdf", lambda c: c <= uniform(F.lit(seed), known, part))),
    )
    return (
        docs.toDF(*[f"_{i}" for i in range(len(lower))])
        .join(rates, source.eqNullSafe(F.col("of_source")))
        .withColumn("count", drawn)
        .where("count > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("count") - 1)))
        .withColumn("shuffle_key", F.md5(F.concat_ws(":", F.lit("order"), F.lit(seed), known, "copy")))
        .withColumn("dealt", F.monotonically_increasing_id())
        .repartition("shuffle_key", "dealt")
        .sortWithinPartitions("shuffle_key")
        .select(*[F.col(place[c]).alias(c) for c in kept], "copy", "shuffle_key")
    )
