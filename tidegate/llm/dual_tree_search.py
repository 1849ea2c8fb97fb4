"""Ranked lexical search by two trees.

A document is a vector: for each term of the items, the term's share of the score if an
item has it. An item is the set of its terms, so its score for a document is the sum of
the document's coordinates at its terms. Documents and items both stand in hierarchies
whose nodes hold coordinate maxima: for documents the largest coordinate below the node,
for items the union of the terms below it. The sum of a document node's maxima over an
item node's terms is at least any score of the pair, so a pair whose bound is below the
weakest kth score of the items under its item node is dropped whole, exactly.

1. One pass cuts the texts into terms; only the counts of the items' terms and the number
   of terms stay. From them come the document frequencies and the mean length.
2. A 32nd of the documents, by hash, is searched first: the kth scores found there are
   lower bounds for all documents, so that every task prunes from its start.
3. Each task builds trees of its documents, block by block, and descends them together
   with the tree of the items; per item it hands on its best k at most.
4. A window per item ranks what the tasks found.

Items are taken in passes of bounded size (``PAIRS`` item-term pairs, or one item), which
is all that the driver holds and sends; each pass goes over all documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm.frames import fields, stored

TOP = 50
PAIRS = 300_000
#: Items below one tree, and below its lowest inner nodes.
ITEMS = 256
GROUP = 8
#: Nodes below a node of documents, and coordinates of a block of documents.
FAN = 8
CELLS = 8_000_000
#: Depth of the item nodes by which documents are placed.
DEPTH = 3
SEEDS = 32

#: Letters A-Z become small; all ASCII but digits and letters becomes a space.
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text, with repeats; null and empty texts have none."""
    return (text or b"").translate(FOLD).split()


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term): each term of an item once; rows that repeat an id are one item."""
    chosen = fields(items, "item_id", "text")
    kind = chosen.schema["item_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for i in range(len(texts)):
                found = list(dict.fromkeys(terms(texts[i].as_py())))
                of = batch.column(0).take(pa.array(np.full(len(found), i)))
                yield pa.RecordBatch.from_arrays([of, pa.array(found, pa.binary())], names=["item_id", "term"])

    return chosen.mapInArrow(cut, f"item_id {kind}, term binary").distinct()


def counted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, counts): for each text with a term its number of terms, and those of the vocabulary."""
    chosen = fields(docs, "doc_id", "text")
    kind = chosen.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            kept, sizes, found, often, ends = [], [], [], [], [0]
            for i in range(len(texts)):
                words = terms(texts[i].as_py())
                if not words:
                    continue
                kept.append(i), sizes.append(len(words))
                times = Counter(words)
                for word in vocabulary.keys() & times.keys():
                    found.append(vocabulary[word]), often.append(times[word])
                ends.append(len(found))
            lists = [
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))
                for values in (found, often)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(kept, pa.int64())), pa.array(sizes, pa.int64()), *lists],
                names=["doc_id", "n", "terms", "counts"],
            )

    return chosen.mapInArrow(count, f"doc_id {kind}, n bigint, terms array<int>, counts array<int>")


@dataclass
class Node:
    """Items below, the union of their terms, and the nodes between."""

    items: np.ndarray
    terms: np.ndarray
    below: list[Node] = field(default_factory=list)


def item_tree(sets: list[np.ndarray], weights: np.ndarray, chosen: np.ndarray) -> Node:
    """Items with common terms of weight stand together: halves around two unlike items."""
    node = Node(chosen, np.unique(np.concatenate([sets[i] for i in chosen])))
    if len(chosen) == 1:
        return node
    if len(chosen) <= GROUP:
        node.below = [Node(chosen[i : i + 1], sets[chosen[i]]) for i in range(len(chosen))]
        return node

    def alike(pivot: int) -> np.ndarray:
        return np.array([weights[np.intersect1d(sets[pivot], sets[i], assume_unique=True)].sum() for i in chosen])

    first = chosen[int(np.argmin(alike(chosen[0])))]
    near = alike(first)
    other = chosen[int(np.argmin(near))]
    order = np.argsort(near - alike(other), kind="stable")
    half = len(chosen) // 2
    node.below = [item_tree(sets, weights, chosen[part]) for part in (order[:half], order[half:])]
    return node


def item_forest(sets: list[np.ndarray], weights: np.ndarray) -> list[tuple[np.ndarray, Node]]:
    """Trees of at most ITEMS items, each with the sorted terms that its nodes' terms count in."""
    forest = []
    for at in range(0, len(sets), ITEMS):
        own = sets[at : at + ITEMS]
        used = np.unique(np.concatenate(own))
        placed = [np.searchsorted(used, s) for s in own]
        tree = item_tree(placed, weights[used], np.arange(len(own)))
        forest.append((used, tree))
    return forest


def coordinates(terms_: np.ndarray, counts: np.ndarray, scale: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """What each term of a document adds to a score; ``scale`` is the document's m, term by term."""
    return weights[terms_] * (1_000_000_000 * counts // (1000 * counts + 20 * scale))


class Best:
    """The k best documents of each item so far, and the score that a new one must reach."""

    def __init__(self, floors: np.ndarray, k: int):
        self.floors, self.k = floors.copy(), k
        self.found: list[list[tuple]] = [[] for _ in floors]

    def add(self, item: int, scores: np.ndarray, ids: list) -> None:
        held = self.found[item]
        held += [(-s, i is None, i, s) for s, i in zip(scores.tolist(), ids, strict=True)]
        if len(held) >= 4 * self.k:
            self.cut(item)

    def cut(self, item: int) -> None:
        held = self.found[item]
        held.sort(key=lambda row: row[:2] + (0 if row[1] else row[2],))
        del held[self.k :]
        if len(held) == self.k:
            self.floors[item] = max(self.floors[item], held[-1][3])


def groups(node: Node, depth: int) -> list[np.ndarray]:
    """The terms of the nodes at that depth, or of the items above it."""
    if not depth or not node.below:
        return [node.terms]
    return [terms_ for child in node.below for terms_ in groups(child, depth - 1)]


class Block:
    """Documents in a tree: leaves of FAN documents, nodes of FAN leaves, and so on to one root.

    Documents stand by the group of items that their coordinates favour, then by their
    sum, so that a node holds documents of like terms and its maxima stay low. All
    arrays are laid out by term, as a sum over terms then reads whole lines.
    """

    def __init__(self, tree: Node, n_terms: int, rows: np.ndarray, columns: np.ndarray, values: np.ndarray, ids: list):
        dense = np.zeros((n_terms, len(ids)), np.int64)
        dense[columns, rows] = values
        favour = np.stack([dense[t].sum(axis=0) / max(len(t), 1) for t in groups(tree, DEPTH)])
        order = np.lexsort((-dense.sum(axis=0), favour.argmax(axis=0)))
        self.ids = [ids[i] for i in order.tolist()]
        self.levels = [np.ascontiguousarray(dense[:, order])]
        while self.levels[0].shape[1] > 1:
            under = self.levels[0]
            self.levels.insert(0, np.maximum.reduceat(under, np.arange(0, under.shape[1], FAN), axis=1))

    def below(self, level: int, nodes: np.ndarray) -> np.ndarray:
        found = (nodes[:, None] * FAN + np.arange(FAN)).ravel()
        return found[found < self.levels[level + 1].shape[1]]


def sums(lines: np.ndarray, terms_: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """The sum of the chosen lines in each of the chosen columns."""
    return lines[np.ix_(terms_, columns)].sum(axis=0)


def descend(node: Node, block: Block, best: Best, first: int, level: int, nodes: np.ndarray) -> None:
    """Follow the pairs of ``node`` and document nodes whose bound reaches an item's floor."""
    bounds = sums(block.levels[level], node.terms, nodes)
    kept = bounds >= best.floors[first + node.items].min()
    nodes, documents = nodes[kept], len(block.levels) - 1
    if not len(nodes):
        return
    if level < documents - 1 or not node.below and level < documents:
        descend(node, block, best, first, level + 1, block.below(level, nodes))
    elif node.below:
        for child in node.below:
            descend(child, block, best, first, level, nodes)
    else:  # one item, and documents whose bound is their score
        best.add(first + int(node.items[0]), bounds[kept], [block.ids[i] for i in nodes.tolist()])


def searched(
    counts: DataFrame, forest: list[tuple[np.ndarray, Node]], item_ids: pa.Array, weights: np.ndarray,
    floors: np.ndarray, totals: tuple[int, int], k: int, kinds: tuple[str, str],
) -> DataFrame:
    """(item_id, doc_id, score): each task's best k documents of each item that reach its floor."""
    n_docs, n_terms = totals
    widest = max(len(used) for used, _ in forest)
    most = max(FAN, CELLS // max(widest, 1))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, id_type = Best(floors, k), None
        for whole in batches:
            id_type = whole.schema.field("doc_id").type
            for at in range(0, len(whole), most):
                batch = whole.slice(at, most)
                ids = batch.column("doc_id").to_pylist()
                lists = batch.column("terms")
                sizes = np.diff(lists.offsets.to_numpy())
                rows = np.repeat(np.arange(len(ids)), sizes)
                which = lists.flatten().to_numpy().astype(np.int64)
                times = batch.column("counts").flatten().to_numpy().astype(np.int64)
                scale = [100 - 50 + 50 * n * n_docs // n_terms for n in batch.column("n").to_pylist()]
                values = coordinates(which, times, np.repeat(np.array(scale, np.int64), sizes), weights)
                first = 0
                for used, tree in forest:
                    place = np.minimum(np.searchsorted(used, which), len(used) - 1)
                    mine = used[place] == which
                    block = Block(tree, len(used), rows[mine], place[mine], values[mine], ids)
                    descend(tree, block, best, first, 0, np.zeros(1, np.int64))
                    first += len(tree.items)
        for item in range(len(floors)):
            best.cut(item)
            held = best.found[item]
            if held:
                yield pa.RecordBatch.from_arrays(
                    [
                        item_ids.take(pa.array([item] * len(held))),
                        pa.array([row[2] for row in held], id_type),
                        pa.array([row[3] for row in held], pa.int64()),
                    ],
                    names=["item_id", "doc_id", "score"],
                )

    return counts.mapInArrow(search, f"item_id {kinds[0]}, doc_id {kinds[1]}, score bigint")


def _top(found: DataFrame, k: int) -> DataFrame:
    ordered = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(ordered)).where(F.col("rank") <= k)


def _pass(docs: DataFrame, pairs: pa.Table, k: int, kinds: tuple[str, str]) -> DataFrame:
    """The answers of the items in ``pairs``, a table (item_id, term) of bounded size."""
    coded = pairs.column("term").combine_chunks().dictionary_encode()
    words = coded.dictionary.to_pylist()
    owners = pairs.column("item_id").combine_chunks().dictionary_encode(null_encoding="encode")
    item_of, term_of = owners.indices.to_numpy(), coded.indices.to_numpy()
    order = np.lexsort((term_of, item_of))
    ends = np.cumsum(np.bincount(item_of))
    sets = [s.astype(np.int64) for s in np.split(term_of[order], ends[:-1])]

    counts = stored(counted(docs, {w: i for i, w in enumerate(words)}), "term-counts")
    n_docs, n_terms = counts.agg(F.count("*"), F.sum("n")).first()
    if not n_docs:
        return counts.sparkSession.createDataFrame([], f"item_id {kinds[0]}, rank int, doc_id {kinds[1]}, score bigint")
    frequency = np.zeros(len(words), np.int64)
    for term, df in counts.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        frequency[term] = df
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in frequency.tolist()], np.int64)

    forest = item_forest(sets, weights)
    args = (forest, owners.dictionary, weights)
    floors = np.ones(len(sets), np.int64)
    some = counts.where(F.pmod(F.xxhash64("doc_id", "n"), F.lit(SEEDS)) == 0)
    places = {item: i for i, item in enumerate(owners.dictionary.to_pylist())}
    reached = _top(searched(some, *args, floors, (n_docs, n_terms), k, kinds), k).where(F.col("rank") == k)
    for item, score in reached.select("item_id", "score").collect():
        floors[places[item]] = max(1, score)
    found = searched(counts, *args, floors, (n_docs, n_terms), k, kinds)
    return _top(found, k).select("item_id", "rank", "doc_id", "score")


def rank(docs: DataFrame, items: DataFrame, k: int = TOP, pairs: int = PAIRS) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k best documents with a score above 0.

    Equal scores rank by doc_id, rows without one last. Null and empty texts have no
    terms: such items get no row, such documents count nowhere. Rows of documents that
    repeat an id are documents of their own; rows of items that do are one item with the
    terms of all. Texts of any length are read whole. Columns other than the ids and text
    are ignored; without documents or items there are no rows.
    """
    spark = docs.sparkSession
    kinds = tuple(fields(t, c).schema[0].dataType.simpleString() for t, c in ((items, "item_id"), (docs, "doc_id")))
    found = stored(item_terms(items), "item-terms")
    passes = -(-found.count() // pairs)
    empty = spark.createDataFrame([], f"item_id {kinds[0]}, rank int, doc_id {kinds[1]}, score bigint")
    mine = F.pmod(F.xxhash64("item_id"), F.lit(max(passes, 1)))
    for part in range(passes):
        table = found.where(mine == part).toArrow()
        if table.num_rows:
            answers = _pass(docs, table, k, kinds)
            empty = empty.unionByName(answers if passes == 1 else stored(answers, "ranked"))
    return empty
