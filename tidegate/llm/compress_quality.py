"""Quality by compression: two zstandard dictionaries, one of good and one of bad text.

A text that compresses better with the dictionary of good text than with that of
bad text looks good. A dictionary helps only near its use, as further on the text's own
history takes over; so a text is compressed in consecutive pieces of ``PART`` bytes,
all of them, each with a fresh use of the dictionary, and the sizes are summed. The difference of the two sizes, divided by the length and by
the sizes' sum, goes through a logistic curve fitted on other labelled documents,
together with the length and the compressed share itself, which the meaning of a
difference depends on.

Labels are learned from documents whose crc32(doc_id) mod 5 is 1 or 2 (dictionaries)
and 3 or 4 (calibration); those with 0 are held out. The dictionaries come from at
most ``SAMPLE`` documents of each class, taken in the order of a hash, and of each a
piece of at most ``PIECE`` characters at a hashed place: 24 MB of ASCII text at most.
The curve is fitted on at most ``CALIBRATION`` rows of five numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.frames import fields, hash_sample, stored

SAMPLE = 3_000
PIECE = 4_000
#: Bytes of a text that are compressed at a time; the last part of a text may be shorter.
PART = 4_000
CALIBRATION = 20_000
DICTIONARY = 112_640
LEVEL = 3
KEEP_FROM = 0.3
FOLDS = 5
FEATURES = ["by_length", "by_size", "log_length", "share"]


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; 1 for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS, F.lit(1))


def class_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, quality): one label for each labelled document, the lowest if several."""
    return (
        fields(labels, "doc_id", "quality")
        .where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )


def sample_pieces(docs: DataFrame, labels: DataFrame, quality: int) -> list[bytes]:
    """The bounded sample of one class, in a fixed order."""
    known = class_labels(labels).where((F.col("quality") == quality) & fold().isin(1, 2))
    chosen = hash_sample(known, SAMPLE, "doc_id").select(F.col("doc_id").alias("chosen_id"))
    spare = F.greatest(F.length("text") - PIECE, F.lit(0)) + 1
    pieces = (
        fields(docs, "doc_id", "text")
        .join(F.broadcast(chosen), F.col("doc_id") == F.col("chosen_id"))
        .select("doc_id", F.substring("text", F.pmod(F.hash("doc_id"), spare) + 1, F.lit(PIECE)).alias("piece"))
        .where(F.length("piece") > 0)
        .orderBy(F.xxhash64("doc_id"), "doc_id", "piece")
        .limit(SAMPLE)
    )
    return [row["piece"].encode() for row in pieces.select("piece").collect()]


def dictionary(pieces: list[bytes]) -> bytes:
    """A trained dictionary, or, of too little text to train on, the text itself."""
    try:
        return zstandard.train_dictionary(DICTIONARY, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(pieces)[-DICTIONARY:]


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    if len(content) < 8:  # zstandard takes no shorter dictionary
        return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
    kind = zstandard.DICT_TYPE_AUTO
    data = zstandard.ZstdCompressionDict(content, dict_type=kind)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=data, write_content_size=False, write_dict_id=False
    )


def compressed_size(by: zstandard.ZstdCompressor, data: bytes) -> int:
    """The sizes of all parts of ``data``, each compressed on its own; an empty text is one part."""
    return sum(len(by.compress(data[i : i + PART])) for i in range(0, max(1, len(data)), PART))


def measure(docs: DataFrame, good: bytes, bad: bytes) -> DataFrame:
    """(doc_id, content, features): each whole text, part by part, compressed with both dictionaries."""
    chosen = fields(docs, "doc_id", "text").withColumn("content", F.xxhash64("text"))
    shared = docs.sparkSession.sparkContext.broadcast((good, bad))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good_by, bad_by = map(compressor, shared.value)
        for batch in batches:
            rows = []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                data = text or b""
                g, b, n = compressed_size(good_by, data), compressed_size(bad_by, data), max(1, len(data))
                if not data:
                    g = b  # nothing to tell apart
                rows.append(((b - g) / n, (b - g) / (b + g), np.log(n), g / n))
            columns = np.array(rows, dtype=float).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("content"), *[pa.array(c) for c in columns.T]],
                names=["doc_id", "content", *FEATURES],
            )

    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(of, f"doc_id {kind}, content bigint, " + ", ".join(f"{f} double" for f in FEATURES))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Intercept and weights, by damped Newton steps; for one class only, its smoothed share."""
    n = len(y)
    prior = (y.sum() + 0.5) / (n + 1)
    weights = np.zeros(x.shape[1] + 1)
    weights[0] = np.log(prior / (1 - prior))
    if n == 0 or y.min() == y.max():
        return weights
    mean, spread = x.mean(axis=0), x.std(axis=0)
    spread[spread == 0] = 1
    z = np.c_[np.ones(n), (x - mean) / spread]
    penalty = np.diag([0.0] + [ridge] * x.shape[1])

    def loss(w: np.ndarray) -> float:
        return float(np.logaddexp(0, z @ w).sum() - y @ (z @ w) + w @ penalty @ w / 2)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ weights, -30, 30)))
        slope = z.T @ (y - p) - penalty @ weights
        step = np.linalg.solve(z.T @ (z * (p * (1 - p) + 1e-9)[:, None]) + penalty + 1e-9 * np.eye(len(weights)), slope)
        size = 1.0
        while size > 1e-6 and loss(weights + size * step) > loss(weights):
            size /= 2
        weights = weights + size * step
        if np.abs(size * step).max() < 1e-8:
            break
    scaled = weights[1:] / spread
    return np.r_[weights[0] - scaled @ mean, scaled]


def classify(
    docs: DataFrame, labels: DataFrame, keep_from: float = KEEP_FROM, with_content: bool = False
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    With ``with_content`` also content, the xxhash64 of the text: rows can share a
    doc_id, and (doc_id, content) says which of them an answer is for.

    ``score`` is the calibrated probability of quality 1. A null text counts as
    empty; empty texts get the score of no difference. Repeated rows get equal
    answers. A null doc_id is scored and not held out. If no labels can be learned
    from, or of one class only, the score is that class's smoothed share (0.5
    without any). Columns other than doc_id, text and quality are ignored; an empty
    table gives no rows.
    """
    good, bad = (dictionary(sample_pieces(docs, labels, q)) for q in (1, 0))
    measured = stored(measure(docs, good, bad), "compressed-sizes")
    known = class_labels(labels).where(fold().isin(3, 4)).select(
        F.col("doc_id").alias("known_id"), "quality"
    )
    labelled = measured.join(known, F.col("doc_id") == F.col("known_id"))
    rows = hash_sample(labelled, CALIBRATION, "doc_id").select(*FEATURES, "quality").collect()
    table = np.array([tuple(r) for r in rows], dtype=float).reshape(-1, len(FEATURES) + 1)
    weights = logistic(table[:, :-1], (table[:, -1] == 1).astype(float))
    logit = F.lit(float(weights[0]))
    for name, weight in zip(FEATURES, weights[1:], strict=True):
        logit = logit + F.lit(float(weight)) * F.col(name)
    return measured.select(
        "doc_id",
        (fold() == 0).alias("held_out"),
        (1 / (1 + F.exp(-logit))).alias("score"),
        *(["content"] if with_content else []),
    ).withColumn("predicted", (F.col("score") >= keep_from).cast("int"))
