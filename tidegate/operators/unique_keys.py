"""The rows whose key may repeat, for keys that are expected to be unique.

Counting rows per key shuffles every key of a nearly unique column. Here keys are hashed
to buckets first, about ``SPARE`` times as many as rows. Each task sends the sorted
buckets of its rows as packed gaps, about a byte a row; what comes in twice is a crowded
bucket. Only rows of crowded buckets, one in ``SPARE`` of unique keys and all rows of
repeated ones, can repeat a key, and only those need to be counted by key.

The crowded buckets come to all tasks as one set of bits, of ``MOST_BITS`` bits at most
(128 MB). A dataset with more rows than that allows is gone through in slices by
hash, each with a set of its own.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.columns import named

# Workers get the functions below with the task, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPARE = 16
MOST_BITS = 30
#: Buckets of a range, which one group of the shuffle decides.
RANGE_BITS = 22
#: Rows whose buckets a task packs at a time.
TOGETHER = 1 << 22


@dataclass(frozen=True)
class Candidates:
    """``rows`` has every row whose key occurs more than once, and few others; ``total`` counts all."""

    rows: DataFrame
    total: int


def candidates(df: DataFrame, keys: list[str], most_bits: int = MOST_BITS) -> Candidates:
    """Find the rows whose key may repeat. Counts ``df`` and runs one pass over its keys now.

    Null keys count as equal, as in the key check. The frame reads ``df`` again, once
    per slice, and passes its rows on unchanged.
    """
    total = df.count()
    wanted = max(SPARE * total, 2).bit_length()
    bits = max(1, min(most_bits, wanted))
    slices = max(1, -(-SPARE * total // (1 << bits)))
    hashed = df.withColumn("__hash", F.xxhash64(*[named(k) for k in keys]))
    parts = []
    for part in range(slices):
        mine = hashed.where(F.pmod("__hash", F.lit(slices)) == part) if slices > 1 else hashed
        crowded = crowded_buckets(mine.select("__hash"), bits)
        parts.append(mine.where(in_crowded(F.col("__hash"), crowded, bits)).drop("__hash"))
    return Candidates(reduce(DataFrame.unionByName, parts), total)


def crowded_buckets(hashes: DataFrame, bits: int) -> Broadcast:
    """One bit for each of the ``2 ** bits`` buckets: whether at least two rows lie in it."""
    inner = min(bits, RANGE_BITS)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(_buckets(batch.column(0), bits))
            n += len(held[-1])
            if n >= TOGETHER:
                yield packed(np.concatenate(held), inner)
                held, n = [], 0
        if n:
            yield packed(np.concatenate(held), inner)

    def decide(table: pa.Table) -> pa.Table:
        once, twice = np.zeros(1 << inner, bool), np.zeros(1 << inner, bool)
        for piece in table["packed"].to_pylist():
            at = unpacked(piece)
            twice[at[1:][at[1:] == at[:-1]]] = True
            twice[at] |= once[at]
            once[at] = True
        whole = zlib.compress(np.packbits(twice).tobytes(), 1)
        return pa.table({"range": table["range"][:1].cast(pa.int32()), "crowded": pa.array([whole], pa.binary())})

    found = (
        hashes.mapInArrow(pack, "range int, packed binary")
        .groupBy("range")
        .applyInArrow(decide, "range int, crowded binary")
        .collect()  # MOST_BITS bits at most
    )
    each = max(1, (1 << inner) // 8)
    crowded = np.zeros(each << (bits - inner), np.uint8)
    for row in found:
        crowded[row["range"] * each : (row["range"] + 1) * each] = np.frombuffer(zlib.decompress(row["crowded"]), np.uint8)
    return hashes.sparkSession.sparkContext.broadcast(crowded)


def in_crowded(hashed: Column, crowded: Broadcast, bits: int) -> Column:
    """Whether the hash lies in a crowded bucket."""

    @F.arrow_udf(T.BooleanType())
    def look(hashes: pa.Array) -> pa.Array:
        bucket = _buckets(hashes, bits)
        return pa.array((crowded.value[bucket >> 3] >> (7 - (bucket & 7)).astype(np.uint8) & 1).astype(bool))

    return look(hashed)


def _buckets(hashes: pa.Array, bits: int) -> np.ndarray:
    """The highest bits of 64-bit hashes."""
    return (np.ascontiguousarray(hashes.to_numpy(zero_copy_only=False)).view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)


def packed(buckets: np.ndarray, inner: int) -> pa.RecordBatch:
    """The buckets by range, each range's as the bytes of the gaps between them."""
    buckets.sort()
    ranges = buckets >> inner
    new = np.flatnonzero(np.diff(ranges, prepend=-1))
    pieces = []
    for start, end in zip(new, [*new[1:], len(buckets)], strict=True):
        inside = buckets[start:end] & ((1 << inner) - 1)
        gaps = np.diff(inside, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4)
        # Plane by plane: high bytes are nearly all zero.
        pieces.append(zlib.compress(np.ascontiguousarray(gaps.T).tobytes(), 1))
    return pa.RecordBatch.from_arrays(
        [pa.array(ranges[new], pa.int32()), pa.array(pieces, pa.binary())], names=["range", "packed"]
    )


def unpacked(piece: bytes) -> np.ndarray:
    """The sorted buckets of a piece, counted from the start of its range."""
    planes = np.frombuffer(zlib.decompress(piece), np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.int64)
