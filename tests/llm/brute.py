"""Plain Python answers to hold the operators against, and awkward input rows."""

from __future__ import annotations

import re

SF_DIR = "/root/testdata/sf0.01"

#: Rows of documents with nulls, empty texts, ties, repeats and odd columns.
AWKWARD = [
    (1, "The cat sat on the mat and then it ran away from the dog today", "en", "a"),
    (1, "The cat sat on the mat and then it ran away from the dog today", "en", "a"),
    (2, None, "en", None),
    (3, "", None, "a"),
    (None, "The cat sat on the mat and then it ran away from the dog today", "en", "b"),
    (4, " \t\n ", "en", "b"),
    (5, "one", "en", "b"),
    (6, "word " * 30_000, "en", "a"),
    (7, "x" * 200_000, "en", "a"),
    (8, "é\x0bè à   ÉÈ!! +1 (555) 123-4567 a@b.co", "fr", "a"),
    (9, " ".join(f"w{i}" for i in range(5_000)), "en", "a"),
]
AWKWARD_SCHEMA = "doc_id bigint, text string, lang string, source string"


def awkward(spark, empty=False):
    """The rows above, with extra columns whose names clash with inner ones."""
    df = spark.createDataFrame([] if empty else AWKWARD, AWKWARD_SCHEMA)
    return df.selectExpr(
        "*", "1 AS n_words", "'x' AS TEXT", "2 AS at", "3 AS fp", "array(1) AS tokens", "4 AS key"
    )


def documents(spark, sf_dir=SF_DIR):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def bench_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text))


class Union:
    def __init__(self):
        self.up = {}

    def root(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)
