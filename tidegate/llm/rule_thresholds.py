"""Quality rules with risk-controlled thresholds.

Every text gets counts and, from them, the statistics that the rules look at. A
rule rejects texts whose statistic is beyond a cutoff. Cutoffs are not guessed:
in each stratum (a language) the rules are tightened together, step by step from their
loosest cutoffs, in an order fixed beforehand. A step is certified if the exact binomial
test, over the labelled good texts of the stratum, says that the rules together reject at
most ``RISK`` of good texts. The first step that fails ends the sequence, so only the strata
need correction (Bonferroni): each is tested at level ``ALPHA`` divided by their number. Up
to the last certified step a rule then goes as far as it rejects no more than its even share
of ``RISK`` in the holdout; that rejects no text which the certified step would keep. Without
a certified step the rules are off in that stratum. So, with probability ``1 - ALPHA``, no
stratum loses more than ``RISK`` of its good texts to these rules.

The trials are the different texts of a stratum: copies of one text are one trial, whatever
number of labelled rows have it. Near copies are trials of their own; as far as they are not
independent the bound is that of a holdout that is drawn in groups, and weaker.

Built-in functions only; the counts are made within each row, without a shuffle.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.frames import fields, indexes, stored, words

RISK = 0.05
ALPHA = 0.05
MIN_WORDS = 50
#: Above so many strata the cutoffs are joined by shuffle instead of broadcast.
BROADCAST_STRATA = 10_000

SHARES = [0.02, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]
#: Statistic -> candidate cutoffs; a text is rejected above the cutoff.
RULES: dict[str, list[float]] = {
    "symbols_per_word": SHARES,
    "repeated_share": SHARES,
    "duplicate_line_share": SHARES,
    "exclamations_per_word": SHARES,
    "chars_per_word": [6.0, 7.0, 8.0, 9.0, 10.0, 12.0, 15.0, 20.0, 30.0],
}


def text_counts(docs: DataFrame) -> DataFrame:
    """doc_id, lang, content (a hash) and the counts of each text; null texts have no words and count 0.

    n_repeat_words: windows of three words are hashed (64 bits) and sorted with
    their places; equal neighbours repeat, and the words they cover are counted.
    """
    tokens = (
        fields(docs, "doc_id", "text", "lang")
        .withColumn("text", F.coalesce("text", F.lit("")))
        .withColumn("tokens", words(F.col("text")))
    )
    windows = F.transform(
        indexes(F.size("tokens"), 3),
        lambda i: F.struct(
            F.xxhash64(F.slice("tokens", i + 1, 3)).alias("key"), i.alias("at")
        ),
    )
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^ \t-\r]"))
    counted = tokens.select(
        "doc_id",
        "lang",
        F.xxhash64("text").alias("content"),
        F.size("tokens").cast("long").alias("n_words"),
        F.char_length(F.array_join("tokens", "")).cast("long").alias("word_chars"),
        (F.char_length("text") - F.char_length(F.regexp_replace("text", r"[#*$%&|<>]+", "")))
        .cast("long")
        .alias("n_symbols"),
        (F.char_length("text") - F.char_length(F.replace("text", F.lit("!"), F.lit(""))))
        .cast("long")
        .alias("n_exclamations"),
        lines.alias("lines"),
        F.sort_array(windows).alias("sorted"),
    )
    key = lambda at: F.get("sorted", at)["key"]
    repeated = F.filter(
        "sorted", lambda x, i: x["key"].eqNullSafe(key(i - 1)) | x["key"].eqNullSafe(key(i + 1))
    )
    placed = counted.select(
        "*", F.sort_array(F.transform(repeated, lambda x: x["at"])).alias("at")
    ).drop("sorted")
    covered = F.aggregate(
        F.transform("at", lambda x, i: F.least(F.lit(3), F.coalesce(x - F.get("at", i - 1), F.lit(3)))),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    )
    return placed.select(
        "doc_id",
        "lang",
        "content",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_exclamations",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
    )


def statistics(counts: DataFrame) -> DataFrame:
    """``counts`` with the statistic of each rule; 0 where there is nothing to divide by."""
    per = lambda part, whole: F.coalesce(F.try_divide(part, whole).cast("double"), F.lit(0.0))
    n = F.col("n_words")
    return counts.withColumns(
        {
            "symbols_per_word": per(F.col("n_symbols"), n),
            "repeated_share": per(F.col("n_repeat_words"), n),
            "duplicate_line_share": per(F.col("n_dup_lines"), F.col("n_lines")),
            "exclamations_per_word": per(F.col("n_exclamations"), n),
            "chars_per_word": per(F.col("word_chars"), n),
        }
    )


def at_most(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p), exactly, summed in logarithms.

    Used where k <= n p; from there on the answer is about a half or more and no
    test passes, so 1 is given.
    """
    odds = math.log(p) - math.log1p(-p)
    start = F.struct(
        (n * math.log1p(-p)).alias("term"), (n * math.log1p(-p)).alias("total")
    )

    def step(acc: Column, i: Column) -> Column:
        term = acc["term"] + F.log((n - i + 1) / i) + odds
        high, low = F.greatest(term, acc["total"]), F.least(term, acc["total"])
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("total"))

    terms = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(
        F.array().cast("array<bigint>")
    )
    return F.when(k > n * p, 1.0).otherwise(
        F.exp(F.aggregate(terms, start, step, lambda acc: acc["total"]))
    )


def thresholds(
    stats: DataFrame,
    labels: DataFrame,
    rules: dict[str, list[float]] | None = None,
    risk: float = RISK,
    alpha: float = ALPHA,
) -> DataFrame:
    """(stratum, <rule>_cut ...): each rule's cutoff by stratum, null where none is certified.

    The holdout is every different text with a label; one with several labels, on one row
    or on copies, counts as good only if all say so.
    """
    rules = rules or RULES
    looser = {rule: sorted(cuts, reverse=True) for rule, cuts in rules.items()}
    steps = max(map(len, looser.values()))
    quality = (
        fields(labels, "doc_id", "quality")
        .groupBy(F.col("doc_id").alias("labelled"))
        .agg(F.min("quality").alias("quality"))
    )
    texts = (
        stats.join(quality, F.col("doc_id") == F.col("labelled"))
        .groupBy(F.col("lang").alias("stratum"), "content")
        .agg(F.min("quality").alias("quality"), *[F.max(rule).alias(rule) for rule in rules])
        .where("quality = 1")
    )
    over = {
        rule: [F.col(rule) > cuts[min(i, len(cuts) - 1)] for i in range(steps)] for rule, cuts in looser.items()
    }
    counts = [F.count_if(test).alias(f"{rule}_{i}") for rule, tests in over.items() for i, test in enumerate(tests)]
    together = [F.count_if(reduce(Column.__or__, tests)).alias(f"any_{i}") for i, tests in enumerate(zip(*over.values()))]
    held = texts.groupBy("stratum").agg(F.count("*").alias("good"), *counts, *together)
    held = stored(held, "holdout-counts")
    level = alpha / max(1, held.count())
    passed = [at_most(F.col(f"any_{i}"), F.col("good"), risk) <= level for i in range(steps)]
    failing = F.array_position(F.array(*passed), False)
    certified = F.when(failing > 0, failing - 1).otherwise(steps).alias("certified")
    # Written, as each cutoff asks for it and would carry all the tests along.
    held = stored(held.select("*", certified), "certified-steps")
    chosen = []
    for rule, cuts in looser.items():
        allowed = [
            F.when((F.lit(i) < F.col("certified")) & (F.col(f"{rule}_{i}") * len(rules) <= F.col("good") * risk), cut)
            for i, cut in enumerate(cuts)
        ]
        chosen.append(F.array_min(F.array(*allowed)).alias(f"{rule}_cut"))
    return held.select("stratum", *chosen)


def judge(
    docs: DataFrame,
    labels: DataFrame,
    rules: dict[str, list[float]] | None = None,
    risk: float = RISK,
    alpha: float = ALPHA,
    broadcast_strata: int = BROADCAST_STRATA,
) -> DataFrame:
    """One row per row of ``docs``: its counts, ``base_failed``, ``kept``, and the rules that reject it.

    A null or empty text has no words and fails the base rule. A null language is
    a stratum. Repeated rows get equal answers, and copies of a text change no cutoff.
    Without labels no rule is certified and only the base rule decides. Texts of any
    length are read whole; an empty table gives no rows. Columns other than doc_id, text,
    lang and quality are ignored. Counts are made once and kept in the shared
    folder, as both the holdout and the verdict need them.
    """
    rules = rules or RULES
    stats = statistics(stored(text_counts(docs), "text-counts"))
    cuts = stored(thresholds(stats, labels, rules, risk, alpha), "rule-cutoffs")
    if cuts.count() <= broadcast_strata:
        cuts = F.broadcast(cuts)
    rejecting = F.filter(
        F.array(*[F.when(F.col(r) > F.col(f"{r}_cut"), r) for r in rules]),
        lambda r: r.isNotNull(),
    )
    n = F.col("n_words")
    return (
        stats.join(cuts, F.col("lang").eqNullSafe(F.col("stratum")), "left")
        .withColumn("base_failed", (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * n))
        .withColumn("rejected_by", rejecting)
        .select(
            "doc_id",
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            "base_failed",
            (~F.col("base_failed") & (F.size("rejected_by") == 0)).alias("kept"),
            "rejected_by",
        )
    )
