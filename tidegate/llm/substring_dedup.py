"""Substring deduplication: suffix automata of reference shards, documents streamed for matching statistics.

A document's words are removed where a window of ``WINDOW`` words also starts in a
document with a smaller doc_id: that is where the matching statistic against the
smaller documents reaches WINDOW.

Two forms:

- ``against_reference``: the reference is a table of its own, of checked size. It is
  cut into shards, one automaton each, broadcast, and every document is streamed
  through all of them.
- ``deduplicate``: the corpus against itself. Such a reference has no size bound, so
  it must not be broadcast and no document can pass all of it. Shards are cut by
  content instead: each window has an anchor, the least hash of its runs of
  ``ANCHOR`` words, equal windows have equal anchors, and consecutive windows mostly
  share one. A stretch of windows with one anchor goes, as text, to that anchor's
  shard; there, documents come in order of doc_id, each is streamed through the
  automaton of the documents before it, and is then added. What repeats is decided by
  words, never by hashes.

Kept small before the shuffle: an anchor that one document alone has is left out, by a
Bloom filter of at most ``FILTER_BITS`` bits of the anchors that several have (a false
hit costs a row, not a wrong answer); of equal stretches in a batch of documents only
the smallest document's is sent, the others are repeats already. An anchor of more than
``HOT`` documents is dealt by single windows instead of stretches, so that its text
is equal throughout and is sent once a batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.frames import fields, stored
from tidegate.llm.suffix_automata import SuffixAutomaton

WINDOW = 13
ANCHOR = 5
HOT = 4_096
FILTER_BITS = 1 << 30
#: Bytes of text that are hashed at a time.
BLOCK = 1 << 20
#: A broadcast reference has at most so many words; a shard so many.
REFERENCE_WORDS, SHARD_WORDS = 200_000, 50_000

SPACES = bytes.maketrans(b"\t\n\x0b\x0c\r", b" " * 5)
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

Arrays = list[np.ndarray]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * BASE)
STEPS = mixed(np.arange(1001, 1001 + WINDOW, dtype=np.uint64) * BASE) | np.uint64(1)


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, by differences of a running polynomial, block by block."""
    out, first = np.empty(len(starts), np.uint64), 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + BLOCK, side="right")))
        low, high = starts[first], ends[last - 1]
        part = BYTES[data[low:high]] * powers(BASE, high - low)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part, dtype=np.uint64)])
        s, e = starts[first:last] - low, ends[first:last] - low
        out[first:last] = (sums[e] - sums[s]) * powers(INVERSE, high - low)[s]
        first = last
    return mixed(out)


def runs(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of so many words."""
    n = max(0, len(hashes) - length + 1)
    total = np.zeros(n, np.uint64)
    for j in range(length):
        total += hashes[j : j + n] * STEPS[j]
    return mixed(total)


class Texts:
    """The words of a batch of documents and their stretches of one anchor."""

    def __init__(self, texts: list[bytes], window: int, anchor: int):
        joined = b" ".join(texts)
        self.bytes = joined.translate(SPACES)
        data = np.frombuffer(self.bytes, np.uint8)
        word = np.concatenate([[False], data != 32, [False]])
        edges = np.flatnonzero(word[1:] != word[:-1])
        self.starts, self.ends = edges[::2], edges[1::2]
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
        self.owner = np.searchsorted(ends, self.starts, side="right")
        self.first = np.searchsorted(self.owner, np.arange(len(texts)))
        self.hashes = word_hashes(data, self.starts, self.ends)
        gaps = np.zeros(len(self.starts) + 1, np.int64)
        gaps[1:-1] = self.starts[1:] - self.ends[:-1] > 1
        self.wide = np.cumsum(gaps)
        self.window = window
        self._stretches(window, anchor)

    def _stretches(self, window: int, anchor: int) -> None:
        n = len(self.starts) - window + 1
        if n <= 0:
            self.anchors, self.at, self.count = (np.zeros(0, t) for t in (np.uint64, np.int64, np.int64))
            return
        least, width, reach = runs(self.hashes, anchor), 1, window - anchor + 1
        while width < reach:  # the least of 1, 2, 4, ... runs from each on
            step = min(width, reach - width)
            least = np.minimum(least[:-step], least[step:])
            width += step
        whole = np.flatnonzero(self.owner[:n] == self.owner[window - 1 :])
        least = least[whole]
        new = np.ones(len(whole), bool)
        new[1:] = (whole[1:] != whole[:-1] + 1) | (least[1:] != least[:-1])
        begin = np.flatnonzero(new)
        self.anchors, self.at = least[begin], whole[begin]
        self.count = np.diff(np.append(begin, len(whole)))

    def text(self, at: int, n: int) -> bytes:
        """The words of n windows from a place on, with single spaces."""
        last = at + n + self.window - 2
        cut = self.bytes[self.starts[at] : self.ends[last]]
        return b" ".join(cut.split()) if self.wide[last] > self.wide[at] else cut


def slices(batch: pa.RecordBatch, window: int, anchor: int) -> Iterator[tuple[int, Texts]]:
    """The batch's texts in blocks of bounded size, with the first row's number."""
    held, size, first = [], 0, 0
    for i, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
        held.append(text or b"")
        size += len(held[-1])
        if size >= BLOCK:
            yield first, Texts(held, window, anchor)
            held, size, first = [], 0, i + 1
    if held:
        yield first, Texts(held, window, anchor)


def anchor_counts(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    """(anchor, n) for the anchors that more than one document has."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in slices(batch, window, anchor):
                owner = texts.owner[texts.at]
                order = np.lexsort((owner, texts.anchors))
                a, o = texts.anchors[order], owner[order]
                new = np.ones(len(a), bool)
                new[1:] = a[1:] != a[:-1]
                other = new.copy()
                other[1:] |= o[1:] != o[:-1]
                begin = np.flatnonzero(new)
                n = np.add.reduceat(other.astype(np.int64), begin) if len(begin) else begin
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a[begin].view(np.int64)), pa.array(n)], names=["anchor", "n"]
                )

    counted = docs.select("text").mapInArrow(of, "anchor bigint, n bigint")
    return counted.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1")


def bloom(anchors: DataFrame, hot: int) -> np.ndarray:
    """Two bit sets of 2 ** k bits each, by an anchor's first k bits: shared anchors, and hot ones."""
    known = stored(anchors, "shared-anchors")
    bits = 1 << 12
    while bits < min(8 * known.count(), FILTER_BITS):
        bits *= 2
    slot = F.shiftrightunsigned("anchor", 64 - (bits.bit_length() - 1))
    bit = F.expr("shiftleft(1L, cast(slot % 64 AS int))")
    rows = (
        known.withColumn("slot", slot)
        .groupBy((F.col("slot") / 64).cast("long").alias("word"))
        .agg(F.bit_or(bit).alias("any"), F.bit_or(F.when(F.col("n") > hot, bit).otherwise(F.lit(0).cast("long"))).alias("hot"))
        .toArrow()
    )
    sets = np.zeros((2, bits // 64), np.int64)
    for i, name in enumerate(("any", "hot")):
        sets[i, rows.column("word").to_numpy()] = rows.column(name).to_numpy()
    return sets.view(np.uint64)


def holds(bits: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    slot = anchors >> np.uint64(64 - (len(bits) * 64 - 1).bit_length())
    return (bits[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)


def stretches(docs: DataFrame, sets: np.ndarray, window: int, anchor: int) -> DataFrame:
    """(anchor, doc_id, content, start, n, words): stretches for the shards.

    Rows without words are decided: their windows repeat a smaller document of the
    same batch. Of rows that repeat a doc_id and text one of each batch is sent.
    """
    shared = docs.sparkSession.sparkContext.broadcast(sets)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ["anchor", "doc_id", "content", "start", "n", "words"]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, hot = shared.value
        for batch in batches:
            first_rows: dict[tuple[object, int], int] = {}
            same = zip(batch.column("doc_id").to_pylist(), batch.column("content").to_pylist(), strict=True)
            for i, key in enumerate(same):
                first_rows.setdefault(key, i)
            batch = batch.take(pa.array(list(first_rows.values()), pa.int64()))
            ids = batch.column("doc_id").to_pylist()
            keys, rows, starts, counts, words = [], [], [], [], []
            for first, texts in slices(batch, window, anchor):
                chosen = np.flatnonzero(holds(known, texts.anchors))
                anchors, at, count = (x[chosen] for x in (texts.anchors, texts.at, texts.count))
                crowded = holds(hot, anchors)
                if crowded.any():
                    n = count[crowded]
                    single = np.repeat(at[crowded] - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
                    every = runs_at(texts.hashes, single, window)
                    anchors = np.concatenate([anchors[~crowded], every])
                    at = np.concatenate([at[~crowded], single])
                    count = np.concatenate([count[~crowded], np.ones(len(single), np.int64)])
                owner = texts.owner[at]
                keys.append(anchors.view(np.int64))
                rows.append(owner + first)
                starts.append(at - texts.first[owner])
                counts.append(count)
                words += [texts.text(a, n) for a, n in zip(at.tolist(), count.tolist(), strict=True)]
            if not words:
                continue
            keys, rows, starts, counts = (np.concatenate(x) for x in (keys, rows, starts, counts))
            least: dict[bytes, object] = {}
            for row, text in zip(rows.tolist(), words, strict=True):
                if text not in least or ids[row] < least[text]:
                    least[text] = ids[row]
            repeat = np.array(
                [least[text] != ids[row] for row, text in zip(rows.tolist(), words, strict=True)]
            )
            fresh = np.flatnonzero(~repeat)
            row, start, n = merged(rows[repeat], starts[repeat], counts[repeat])
            # What is decided goes to no anchor's shard; its key only spreads it.
            spread = mixed((row * 8191 + start).astype(np.uint64)).view(np.int64)
            keys = np.concatenate([keys[fresh], spread])
            starts = np.concatenate([starts[fresh], start])
            counts = np.concatenate([counts[fresh], n])
            sent = [words[i] for i in fresh.tolist()] + [None] * len(row)
            at = pa.array(np.concatenate([rows[fresh], row]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys),
                    batch.column("doc_id").take(at),
                    batch.column("content").take(at),
                    pa.array(starts.astype(np.int32)),
                    pa.array(counts.astype(np.int32)),
                    pa.array(sent, pa.binary()),
                ],
                names=names,
            )

    return docs.mapInArrow(
        of, f"anchor bigint, doc_id {id_type}, content bigint, start int, n int, words binary"
    )


def merged(rows: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Adjoining stretches of one row as one."""
    order = np.lexsort((starts, rows))
    rows, starts, counts = rows[order], starts[order], counts[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (starts[1:] != starts[:-1] + counts[:-1])
    begin = np.flatnonzero(new)
    return rows[begin], starts[begin], np.add.reduceat(counts, begin) if len(begin) else counts


def runs_at(hashes: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    total = np.zeros(len(at), np.uint64)
    for j in range(length):
        total += hashes[at + j] * STEPS[j]
    return mixed(total)


class Shard:
    """The stretches of one anchor so far, by documents in order; an automaton once two differ."""

    def __init__(self, window: int):
        self.window, self.texts, self.waiting = window, {}, []
        self.automaton: SuffixAutomaton | None = None

    def repeated(self, text: bytes, n: int) -> np.ndarray:
        """Which of the text's n windows occur in the documents added before."""
        if text in self.texts:
            return np.ones(n, bool)
        if not self.texts:
            return np.zeros(n, bool)
        self.automaton = self.automaton or SuffixAutomaton()
        for earlier in self.waiting:
            self.automaton.add(earlier.split(b" "))
        self.waiting = []
        matched = self.automaton.statistics(text.split(b" "))
        return np.array(matched[self.window - 1 :]) >= self.window

    def add(self, text: bytes) -> None:
        if text not in self.texts:
            self.texts[text] = None
            self.waiting.append(text)


def spans(flags: np.ndarray) -> list[tuple[int, int]]:
    """(start, n) of each run of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), (edges[1::2] - edges[::2]).tolist(), strict=True))


def stream(dealt: DataFrame, window: int) -> DataFrame:
    """(doc_id, content, start, n): runs of windows that occur in a smaller document."""
    id_type = dealt.schema["doc_id"].dataType.simpleString()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, doc, shard, added = None, None, Shard(window), []
        for batch in batches:
            at, starts, counts = [], [], []
            rows = zip(*[batch.column(c).to_pylist() for c in ("anchor", "doc_id", "start", "n", "words")], strict=True)
            for i, (key, doc_id, start, n, text) in enumerate(rows):
                if text is None:
                    at.append(i), starts.append(start), counts.append(n)
                    continue
                if key != anchor:
                    anchor, doc, shard, added = key, doc_id, Shard(window), []
                elif doc_id != doc:
                    for earlier in added:
                        shard.add(earlier)
                    doc, added = doc_id, []
                for offset, length in spans(shard.repeated(text, n)):
                    at.append(i), starts.append(start + offset), counts.append(length)
                added.append(text)
            rows_at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(rows_at),
                    batch.column("content").take(rows_at),
                    pa.array(starts, pa.int32()),
                    pa.array(counts, pa.int32()),
                ],
                names=["doc_id", "content", "start", "n"],
            )

    return dealt.mapInArrow(of, f"doc_id {id_type}, content bigint, start int, n int")


def covered(n_words: int, windows: list[dict] | None, window: int) -> np.ndarray:
    """Which words lie in one of the runs of windows."""
    edge = np.zeros(n_words + 1, np.int64)
    for run in windows or ():
        edge[run["start"]] += 1
        edge[min(n_words, run["start"] + run["n"] + window - 1)] -= 1
    return np.cumsum(edge[:-1]) > 0


def removal(docs: DataFrame, window: int) -> DataFrame:
    """Apply the column ``windows``: doc_id, n_words, n_removed, kept_sha256, kept."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, digests, kept = [], [], [], []
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for text, windows in zip(texts, batch.column("windows").to_pylist(), strict=True):
                words = (text or b"").split()
                counts.append(len(words))
                if windows:
                    words = [words[i] for i in np.flatnonzero(~covered(len(words), windows, window)).tolist()]
                removed.append(counts[-1] - len(words))
                kept.append(b" ".join(words))
                digests.append(hashlib.sha256(kept[-1]).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"],
            )

    return docs.select("doc_id", "text", "windows").mapInArrow(
        of, f"doc_id {id_type}, n_words bigint, n_removed bigint, kept_sha256 string, kept string"
    )


def deduplicate(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, hot: int = HOT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256, kept.

    A null text has no words. Rows that repeat a doc_id do not make each other's
    words repeats, as neither id is smaller; both lose what a smaller one has. A row
    without doc_id is kept whole and removes nothing. Repeats within one document
    stay. Columns other than doc_id and text are ignored; an empty table gives no rows.
    """
    read = fields(docs, "doc_id", "text").withColumn("content", F.xxhash64("text"))
    named = read.where("doc_id IS NOT NULL AND text IS NOT NULL")
    sets = bloom(anchor_counts(named, window, anchor), hot)
    dealt = (
        stretches(named, sets, window, anchor)
        .repartition("anchor")
        .sortWithinPartitions("anchor", "doc_id", "content", "start")
    )
    windows = (
        stream(dealt, window)
        .groupBy(F.col("doc_id").alias("of_id"), F.col("content").alias("of_content"))
        .agg(F.collect_set(F.struct("start", "n")).alias("windows"))
    )
    joined = read.join(
        windows, (F.col("doc_id") == F.col("of_id")) & (F.col("content") == F.col("of_content")), "left"
    )
    return removal(joined, window)


def against_reference(docs: DataFrame, reference: DataFrame, window: int = WINDOW) -> DataFrame:
    """Like ``deduplicate``, but removes what occurs in ``reference`` (a table with ``text``).

    The reference may have ``REFERENCE_WORDS`` words at most and is broadcast as its
    words; each worker builds the automata of its shards once. A larger reference
    raises ValueError: put it into the corpus with smaller ids and deduplicate.
    """
    texts = fields(reference, "text").where("text IS NOT NULL")
    size = texts.agg(F.sum(F.size(F.split("text", r"[ \t-\r]+")))).first()[0] or 0
    if size > REFERENCE_WORDS:
        raise ValueError(f"a reference of {size} words is too large to broadcast")
    shards: list[list[list[bytes]]] = [[]]
    held = 0
    for row in texts.orderBy("text").collect():
        words = row["text"].encode().split()
        if held and held + len(words) > SHARD_WORDS:
            shards.append([])
            held = 0
        shards[-1].append(words)
        held += len(words)
    shared = docs.sparkSession.sparkContext.broadcast(shards)
    read = fields(docs, "doc_id", "text")
    schema = read.schema.simpleString().removeprefix("struct<").removesuffix(">")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = []
        for shard in shared.value:
            automata.append(SuffixAutomaton())
            for words in shard:
                automata[-1].add(words)
        for batch in batches:
            found = []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                words = (text or b"").split()
                longest = np.zeros(len(words), np.int64)
                for automaton in automata:
                    longest = np.maximum(longest, np.array(automaton.statistics(words), np.int64))
                flags = longest[window - 1 :] >= window
                found.append([{"start": s, "n": n} for s, n in spans(flags)])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("n", pa.int32())]))
            yield batch.append_column("windows", pa.array(found, kind))

    return removal(read.mapInArrow(of, f"{schema}, windows array<struct<start:int,n:int>>"), window)
