"""Benchmark decontamination: a broadcast hash set of test n-grams, scanned over token windows.

The windows of all benchmark items are hashed and broadcast, each row with the
n-gram itself. Documents are cut to words, each window is hashed by a few words spread
over it, and the hash join keeps those that may occur in the benchmark; they are
verified word by word. Everything is built-in functions; no text is shuffled, only its hits.

Benchmarks beyond ``BROADCAST_WINDOWS`` or ``BROADCAST_BYTES`` are not broadcast. Then the
documents' windows are shuffled as document, place and key; texts join the documents that
have such keys once, and only the windows found are cut out of them for verification.

Words: A-Z lower-cased, then runs of digits, a-z and characters beyond ASCII. A
window is ``WINDOW`` consecutive words of one item; a shorter item is one window.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.frames import fields, indexes, stored, words

WINDOW = 13
#: A document is contaminated if at least one word in so many is hit.
ONE_IN = 20
#: Words of a window that its key hashes.
SAMPLES = 5
#: Above so many benchmark windows, or bytes of them, the set is joined by shuffles instead.
BROADCAST_WINDOWS = 500_000
BROADCAST_BYTES = 128 * 1024 * 1024

SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def folded(text: Column) -> Column:
    """A-Z in lower case, all else unchanged."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def _key(tokens: str, at: Column | int, length: int) -> Column:
    """A hash of ``SAMPLES`` words spread over a window; equal windows have equal keys.

    Hashing all words would cost more than the rest of the scan. Windows that only
    agree in these words meet in the join and are told apart by verification.
    """
    places = sorted({round(j * (length - 1) / (SAMPLES - 1)) for j in range(SAMPLES)})
    return F.xxhash64(*[F.get(tokens, F.lit(at) + p if isinstance(at, int) else at + p) for p in places])


def _grams(read: DataFrame, lengths: list[int]) -> DataFrame:
    """``read`` with a row for every window of each length: at, len, key.

    With one length, as a benchmark of longer items has, keys are plain numbers.
    """

    def keys(length: int) -> Column:
        return F.transform(indexes(F.size("tokens"), length), lambda i: _key("tokens", i, length))

    if len(lengths) == 1:
        placed = read.select("*", F.posexplode(keys(lengths[0])).alias("at", "key"))
        return placed.withColumn("len", F.lit(lengths[0]))

    def sized(length: int) -> Column:
        return F.transform(
            keys(length),
            lambda key, i: F.struct(i.alias("at"), F.lit(length).alias("len"), key.alias("key")),
        )

    return read.select("*", F.inline(F.concat(*map(sized, lengths))))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(key, gram_len, gram, items): each window once, with the ids, as strings, of the items that have it.

    Items without words have none; items without an id are not listed.
    """
    items = fields(benchmark, "item_id", "text").select(
        "item_id", words(folded(F.col("text")), SEPARATOR).alias("tokens")
    )
    starts = indexes(F.size("tokens"), window)
    whole = F.array(F.lit(0))
    some = F.size("tokens") > 0
    return (
        items.where(some)
        .select(
            "item_id",
            "tokens",
            F.explode(F.when(F.size("tokens") < window, whole).otherwise(starts)).alias("at"),
        )
        .select("item_id", F.slice("tokens", F.col("at") + 1, window).alias("gram"))
        .select(
            reduce(
                lambda other, n: F.when(F.size("gram") == n, _key("gram", 0, n)).otherwise(other),
                range(1, window + 1),
                F.lit(None).cast("long"),
            ).alias("key"),
            F.size("gram").alias("gram_len"),
            F.array_join("gram", " ").alias("gram"),
            F.col("item_id").cast("string").alias("item"),
        )
        .groupBy("key", "gram_len", "gram")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )


def _window(tokens: str) -> Column:
    return F.array_join(F.slice(tokens, F.col("at") + 1, F.col("len")), " ")


def _tokens(text: str) -> Column:
    return words(folded(F.col(text)), SEPARATOR).alias("tokens")


def _hits_by_broadcast(read: DataFrame, grams: DataFrame, lengths: list[int]) -> DataFrame:
    """(doc_id, content, at, len, items): the documents' windows that are in ``grams``."""
    return (
        _grams(read.select("doc_id", "content", _tokens("text")), lengths)
        .join(F.broadcast(grams), "key")  # a join on one long is the fastest
        .where((F.col("len") == F.col("gram_len")) & (_window("tokens") == F.col("gram")))
        .select("doc_id", "content", "at", "len", "items")
    )


def _hits_by_shuffle(read: DataFrame, grams: DataFrame, lengths: list[int]) -> DataFrame:
    """As ``_hits_by_broadcast``; what is shuffled grows with the text, not with its square."""
    sized = F.col("len") == F.col("gram_len")
    known = grams.select("key", "gram_len").distinct()
    places = (
        _grams(read.select("doc_id", "content", _tokens("text")), lengths)
        .select("doc_id", "content", "at", "len", "key")
        .join(known, "key")
        .where(sized)
        .groupBy("doc_id", "content")
        .agg(F.collect_set(F.struct("at", "len", "key")).alias("places"))
        .toDF("hit_id", "hit_content", "places")
    )
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("content") == F.col("hit_content"))
    cut = (
        read.join(places, same)
        .select("doc_id", "content", _tokens("text"), "places")
        .select("doc_id", "content", "tokens", F.inline("places"))
        .select("doc_id", "content", "at", "len", "key", _window("tokens").alias("seen"))
    )
    found = cut.join(grams, "key").where(sized & (F.col("seen") == F.col("gram")))
    return found.select("doc_id", "content", "at", "len", "items")


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    one_in: int = ONE_IN,
    broadcast_windows: int = BROADCAST_WINDOWS,
    with_content: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, hit_at.

    With ``with_content`` also content, the xxhash64 of the text: rows can share a
    doc_id, and (doc_id, content) says which of them an answer is for.

    ``hit_at`` lists the 0-based positions of the hit words. A null or empty text
    has no words, no hits and is clean; so is every document if the benchmark is
    empty. Repeated rows get equal answers, a null doc_id is kept. Items without
    an id hit words but are not counted; an id given twice counts once. An empty table of
    documents gives no rows. A very long text has one row a window inside its task, and the
    places it is hit at, a list as long as the text at most, in its own row. Columns other
    than doc_id, text and item_id are ignored.
    """
    grams = stored(benchmark_windows(benchmark, window), "benchmark-windows")
    held = F.octet_length("gram") + F.octet_length(F.array_join("items", ",")) + 8 * F.size("items") + 64
    n, lengths, size = grams.agg(F.count("*"), F.collect_set("gram_len"), F.sum(held.cast("long"))).first()
    small = n <= broadcast_windows and (size or 0) <= BROADCAST_BYTES
    hits = _hits_by_broadcast if small else _hits_by_shuffle

    read = fields(docs, "doc_id", "text").select("doc_id", F.xxhash64("text").alias("content"), "text")
    found = (
        hits(read, grams, sorted(lengths) or [window])
        .groupBy("doc_id", "content")
        .agg(
            F.collect_set(F.struct("at", "len")).alias("spans"),
            F.collect_set("items").alias("items"),
        )
        .select(
            F.col("doc_id").alias("hit_id"),
            F.col("content").alias("hit_content"),
            F.array_sort(
                F.array_distinct(
                    F.flatten(
                        F.transform(
                            "spans", lambda s: F.sequence(s["at"], s["at"] + s["len"] - 1)
                        )
                    )
                )
            ).alias("hit_at"),
            F.array_sort(F.array_distinct(F.flatten("items"))).alias("items"),
        )
    )
    counted = read.select("doc_id", "content", F.size(_tokens("text")).cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    content = ["content"] if with_content else []
    return (
        counted.join(
            found,
            F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("content") == F.col("hit_content")),
            "left",
        )
        .select(
            "doc_id",
            "n_words",
            F.coalesce("hit_at", F.array().cast("array<int>")).alias("hit_at"),
            F.coalesce("items", none).alias("items"),
            *content,
        )
        .select(
            "doc_id",
            "n_words",
            F.size("hit_at").cast("long").alias("n_hit"),
            F.size("items").cast("long").alias("n_items"),
            F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
            (
                (F.size("hit_at") > 0) & (one_in * F.size("hit_at").cast("long") >= F.col("n_words"))
            ).alias("contaminated"),
            "hit_at",
            *content,
        )
    )
