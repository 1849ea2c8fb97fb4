"""Hard negatives found through an inverted multi-index, exactly.

Vectors are cut into two halves, each half has a codebook, and a pair of codewords is a
cell. A row's score with an anchor q is an integer inner product; in the cell (i, j) it is
at most the sum of two half-scores, q1 . c_i + |q1| r_i and q2 . c_j + |q2| r_j, with the
radii r over all rows. So cells are visited from a heap in the order of that sum
(multi-sequence), and a visit ends as soon as the next sum is below what could still
change the answer:

* positives, the first rows of the anchor's label: below the weakest one held;
* negatives, for each positive the first rows of other labels whose score lies in a
  window below the positive's: below every window's weakest row held or lower end.

Then the answer is certified. The codebooks come from a bounded sample of rows
(``SAMPLE``); codes and radii cover every row. The index is a table sorted by cell;
each task visits the cells among its rows, and a window function merges what tasks find.
A 16th of the index, by hash, is visited first: the weakest rows held there are floors
for all tasks. Anchors are sent out in batches of ``COMPONENTS`` components at most.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm.frames import fields, hash_sample, stored

POSITIVES = 5
NEGATIVES = 3
#: Window of a negative's score, in hundredths of the positive's.
LOW, HIGH = 50, 95
SAMPLE = 20_000
#: Rows that a cell should hold, and the most codewords of a half.
CELL = 512
CODEWORDS = 256
ROUNDS = 10
COMPONENTS = 1 << 20
#: Rows of a task of the index at least, and the most tasks.
ROWS = 4096
TASKS = 20_000
SEEDS = 16


def quantised(rows: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, label, v): rows fit to take part, their components as floor(scale * x).

    Rows without vec_id or label, without a vector or with a null or non-finite component
    take no part; of rows that repeat a vec_id the least by label and vector does.
    """
    chosen = fields(rows, "vec_id", "label", "embedding")
    finite = F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")),
    )
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    fit = chosen.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").where(finite)
    least = fit.groupBy("vec_id").agg(F.min(F.struct("label", whole.alias("v"))).alias("least"))
    return least.select("vec_id", "least.label", "least.v")


def matrix(vectors: pa.Array, dims: int) -> np.ndarray:
    """Lists of integers as rows of doubles; short ones are filled up with zeros."""
    sizes = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(sizes), dims))
    starts = np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(sizes.sum()) - starts] = vectors.flatten().to_numpy()
    return out


def nearest(points: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each point's nearest codeword and its distance."""
    code = np.argmin((words * words).sum(axis=1) - 2 * points @ words.T, axis=1)
    return code, np.sqrt(((points - words[code]) ** 2).sum(axis=1))


def codebook(points: np.ndarray, size: int) -> np.ndarray:
    """Codewords by Lloyd's rounds from evenly spaced starting points."""
    words = points[np.linspace(0, len(points) - 1, size).astype(int)].copy()
    for _ in range(ROUNDS):
        code, _ = nearest(points, words)
        for c in np.unique(code):
            words[c] = points[code == c].mean(axis=0)
    return words


@dataclass
class Index:
    """The table (i, j, vec_id, label, v) sorted by cell, and what bounds need."""

    table: DataFrame
    words: list[np.ndarray]
    radii: list[np.ndarray]
    dims: int

    def share(self, seeds: int) -> DataFrame:
        return self.table.where(F.pmod(F.xxhash64("vec_id"), F.lit(seeds)) == 0)


def build(rows: DataFrame, sample: int = SAMPLE, cell: int = CELL) -> Index | None:
    """The index of quantised ``rows``; None without rows."""
    size = F.max(F.size("v"))
    far = F.max(F.aggregate("v", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x.cast("double")))))
    n, dims, largest = rows.agg(F.count("*"), size, far).first()
    if not n:
        return None
    if dims * largest**2 >= 2.0**53:
        raise ValueError("Components are too large for scores to be exact")
    some = matrix(hash_sample(rows, sample, "vec_id").toArrow().column("v").combine_chunks(), dims)
    cut = dims // 2
    most = max(1, min(CODEWORDS, len(some), round((n / cell) ** 0.5)))
    words = [codebook(half, most) for half in (some[:, :cut], some[:, cut:])]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = matrix(batch.column("v"), dims)
            (i, a), (j, b) = (nearest(h, w) for h, w in zip((points[:, :cut], points[:, cut:]), words, strict=True))
            added = [pa.array(x, t) for x, t in ((i, pa.int32()), (j, pa.int32()), (a, pa.float64()), (b, pa.float64()))]
            yield pa.RecordBatch.from_arrays([*added, *batch.columns], names=["i", "j", "a", "b", *batch.schema.names])

    inner = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    parts = max(1, min(TASKS, n // ROWS))
    table = stored(
        rows.mapInArrow(encode, f"i int, j int, a double, b double, {inner}")
        .repartitionByRange(parts, "i", "j", "vec_id")  # a crowded cell is cut by vec_id
        .sortWithinPartitions("i", "j", "vec_id"),
        "multi-index",
    )
    radii = [np.zeros(most), np.zeros(most)]
    for side, (code, reach) in enumerate((("i", "a"), ("j", "b"))):
        for at, radius in table.groupBy(code).agg(F.max(reach)).collect():  # CODEWORDS rows at most
            radii[side][at] = radius
    return Index(table.drop("a", "b"), words, radii, dims)


class Cells:
    """Some rows of the index, by cell."""

    def __init__(self, batch: pa.RecordBatch, index: Index):
        self.points = matrix(batch.column("v"), index.dims)
        self.ids = batch.column("vec_id").to_numpy()
        self.labels = batch.column("label").to_numpy(zero_copy_only=False)
        codes = [batch.column(c).to_numpy().astype(np.int64) for c in ("i", "j")]
        self.codes, places = zip(*(np.unique(c, return_inverse=True) for c in codes), strict=True)
        cell = places[0] * len(self.codes[1]) + places[1]
        self.order = np.argsort(cell, kind="stable")
        self.ends = np.cumsum(np.bincount(cell, minlength=len(self.codes[0]) * len(self.codes[1])))
        self.points, self.ids, self.labels = (x[self.order] for x in (self.points, self.ids, self.labels))

    def bounds(self, anchors: np.ndarray, index: Index) -> list[np.ndarray]:
        """The half-score bounds of each anchor, for the codewords that occur here."""
        cut, found = index.dims // 2, []
        for half, words, radii, codes in zip(
            (anchors[:, :cut], anchors[:, cut:]), index.words, index.radii, self.codes, strict=True
        ):
            length = np.sqrt((half * half).sum(axis=1))
            bound = half @ words[codes].T + length[:, None] * radii[codes]
            found.append(bound + 1e-6 * (1 + np.abs(bound)))  # rounding must not lower a bound
        return found

    def visit(self, first: np.ndarray, second: np.ndarray, floor: Callable[[], float]) -> Iterator[slice]:
        """The rows of each cell whose bound reaches ``floor()``, the highest bound first."""
        i_order, j_order = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
        high, low = first[i_order].tolist(), second[j_order].tolist()
        heap = [(-(high[0] + low[0]), 0, 0)]
        while heap:
            bound, i, j = heapq.heappop(heap)
            if -bound < floor():
                return
            if j + 1 < len(low):
                heapq.heappush(heap, (-(high[i] + low[j + 1]), i, j + 1))
            if not j and i + 1 < len(high):
                heapq.heappush(heap, (-(high[i + 1] + low[0]), i + 1, 0))
            cell = i_order[i] * len(low) + j_order[j]
            start, end = int(self.ends[cell - 1]) if cell else 0, int(self.ends[cell])
            if start < end:
                yield slice(start, end)


class Held:
    """The best rows so far, by score and then by the smaller id; ``floor`` is what a row must reach."""

    def __init__(self, size: int, floor: float):
        self.size, self.floor, self.rows = size, floor, []

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        good = np.flatnonzero(scores >= self.floor)
        if not len(good):
            return
        self.rows += zip((-scores[good]).tolist(), ids[good].tolist(), strict=True)
        self.rows.sort()
        del self.rows[self.size :]
        if len(self.rows) == self.size:
            self.floor = max(self.floor, -self.rows[-1][0])


def _chunks(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)


def find_positives(index: DataFrame, of: Index, anchors: pa.Table, floors: np.ndarray, k: int) -> DataFrame:
    """(anchor_id, positive_id, positive_score): each task's first k other rows of the anchor's label."""
    ids, labels = (anchors.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in ("vec_id", "label"))
    points = matrix(anchors.column("v").combine_chunks(), of.dims)
    of = Index(None, of.words, of.radii, of.dims)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [Held(k, f) for f in floors.tolist()]
        for batch in _chunks(batches):
            cells = Cells(batch, of)
            first, second = cells.bounds(points, of)
            for a, mine in enumerate(held):
                for rows in cells.visit(first[a], second[a], lambda: mine.floor):
                    same = (cells.labels[rows] == labels[a]) & (cells.ids[rows] != ids[a])
                    mine.add((cells.points[rows] @ points[a])[same], cells.ids[rows][same])
        found = [(ids[a], i, -s) for a, mine in enumerate(held) for s, i in mine.rows]
        columns = [pa.array([row[c] for row in found]).cast(pa.int64()) for c in range(3)]
        yield pa.RecordBatch.from_arrays(columns, names=["anchor_id", "positive_id", "positive_score"])

    return index.mapInArrow(search, "anchor_id bigint, positive_id bigint, positive_score bigint")


def find_negatives(
    index: DataFrame, of: Index, anchors: pa.Table, wanted: dict[int, list[tuple[int, int, float]]],
    k: int, low: int, high: int,
) -> DataFrame:
    """Each task's first k rows of other labels in each window; ``wanted`` has them by anchor."""
    ids, labels = (anchors.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in ("vec_id", "label"))
    points = matrix(anchors.column("v").combine_chunks(), of.dims)
    of = Index(None, of.words, of.radii, of.dims)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {
            a: [(p, s, high * s, Held(k, max(floor, low * s / 100))) for p, s, floor in wanted[i]]
            for a, i in enumerate(ids.tolist())
            if wanted.get(i)
        }
        for batch in _chunks(batches):
            cells = Cells(batch, of)
            first, second = cells.bounds(points, of)
            for a, windows in held.items():
                for rows in cells.visit(first[a], second[a], lambda: min(w[3].floor for w in windows)):
                    other = cells.labels[rows] != labels[a]
                    scores, own = (cells.points[rows] @ points[a])[other], cells.ids[rows][other]
                    for _, _, top, mine in windows:
                        below = 100 * scores <= top
                        mine.add(scores[below], own[below])
        found = [
            (ids[a], p, i, s, -score)
            for a, windows in held.items()
            for p, s, _, mine in windows
            for score, i in mine.rows
        ]
        columns = [pa.array([row[c] for row in found]).cast(pa.int64()) for c in range(5)]
        yield pa.RecordBatch.from_arrays(columns, names=NEGATIVE.replace(" bigint", "").split(", "))

    return index.mapInArrow(search, NEGATIVE)


NEGATIVE = "anchor_id bigint, positive_id bigint, negative_id bigint, positive_score bigint, negative_score bigint"


def _first(found: DataFrame, group: list[str], score: str, by: str, k: int) -> DataFrame:
    ordered = Window.partitionBy(*group).orderBy(F.desc(score), by)
    return found.withColumn("rank", F.row_number().over(ordered)).where(F.col("rank") <= k)


def _batch(index: Index, anchors: pa.Table, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    places = {v: i for i, v in enumerate(anchors.column("vec_id").to_pylist())}
    floors = np.full(len(places), -np.inf)
    seeds = index.share(SEEDS)
    reached = _first(
        find_positives(seeds, index, anchors, floors, positives), ["anchor_id"], "positive_score", "positive_id", positives
    ).where(F.col("rank") == positives)
    for row in reached.collect():  # one row per anchor of the batch
        floors[places[row["anchor_id"]]] = row["positive_score"]
    pairs = stored(
        _first(
            find_positives(index.table, index, anchors, floors, positives),
            ["anchor_id"], "positive_score", "positive_id", positives,
        ),
        "positives",
    )
    wanted: dict[int, list] = {}
    for row in pairs.collect():  # a few rows per anchor of the batch
        if row["positive_score"] >= 0:  # else no score lies in the window
            wanted.setdefault(row["anchor_id"], []).append((row["positive_id"], row["positive_score"], -np.inf))

    group = ["anchor_id", "positive_id"]

    def merged(table: DataFrame) -> DataFrame:
        found = find_negatives(table, index, anchors, wanted, negatives, low, high)
        return _first(found, group, "negative_score", "negative_id", negatives)

    weakest = {
        (row["anchor_id"], row["positive_id"]): row["negative_score"]
        for row in merged(seeds).where(F.col("rank") == negatives).collect()
    }
    wanted = {
        a: [(p, s, weakest.get((a, p), -np.inf)) for p, s, _ in windows] for a, windows in wanted.items()
    }
    return stored(merged(index.table), "negatives").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def mine(
    rows: DataFrame,
    anchor: Column | str,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    cell: int = CELL,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows`` has vec_id, label and embedding; anchors are the rows for which ``anchor`` holds.
    An anchor's positives are its first other rows of its label, by score and then by
    vec_id. Negatives are the first rows of another label whose score is at least
    ``low`` and at most ``high`` hundredths of the positive's; a positive with a negative
    score has none. Which rows take part is told by ``quantised``; vectors
    shorter than the longest are filled up with zeros, and components beyond
    what gives exact scores in 53 bits raise a ValueError. Other columns are ignored;
    without rows or anchors there are no rows.
    """
    fit = stored(quantised(rows), "quantised")
    index = build(fit, cell=cell)
    empty = rows.sparkSession.createDataFrame([], RESULT)
    if index is None:
        return empty
    asked = fit.where(anchor)
    batches = -(-asked.count() * max(index.dims, 1) // COMPONENTS)
    place = F.pmod(F.xxhash64("vec_id"), F.lit(max(batches, 1)))
    for at in range(batches):
        anchors = asked.where(place == at).toArrow()
        if anchors.num_rows:
            empty = empty.unionByName(_batch(index, anchors, positives, negatives, low, high))
    return empty
