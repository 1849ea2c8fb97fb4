"""Document fingerprints by a randomised edit embedding.

All texts are read by one shared random walk. At step j the walker reads the character
c under it and then stays or moves on by one, as a random bit of (j, c) says; the bits
repeat every ``PERIOD`` steps. Two texts that differ in an edit read unlike characters
there, but their shift in time is a fair random walk, so they meet again after a while
and then read alike to the next edit: a small edit distance gives a small Hamming
distance between the sequences of characters read.

The fingerprint samples that sequence at ``BITS`` steps and keeps one random bit of each
character read. The b-th step is the place of the least of L random numbers that all
texts share, L being the steps the whole text takes: it is uniform over the walk, and
equal for texts of nearly equal length. An empty text has the fingerprint zero.

Near-duplicates have fingerprints that differ in at most ``DISTANCE`` bits. The bits are
dealt to DISTANCE + 1 bands; two such fingerprints agree in at least one band, so texts
meet by band, and whole fingerprints decide. No link is lost.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.components import components
from tidegate.llm.frames import fields, hash_sample, stored

BITS = 256
PERIOD = 4096
CLASSES = 256
SEED = 11
DISTANCE = 8
#: Longest walk whose sampled steps are known; far beyond any text.
LONGEST = 1 << 48
PIECE = 1 << 16
#: Fewer texts than this are walked one by one, more of them side by side.
LANES = 96
#: Characters that are walked at a time, in whole texts.
TOGETHER = 4_000_000
#: Rows of a block of neighbours, and the most blocks.
BLOCK = 1024
BLOCKS = 1 << 15
#: Distinct fingerprints of a band's bucket above which it is cut into parts that all meet.
CROWD = 2048
BATCH = 100_000


def _random(n: int, salt: int) -> np.ndarray:
    """n 64-bit numbers, the same ones everywhere."""
    with np.errstate(over="ignore"):
        x = (np.arange(n, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        x += np.uint64(SEED * 1_000_003 + salt) * np.uint64(0xD1342543DE82EF95)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return x ^ (x >> np.uint64(31))


@cache
def _stays() -> np.ndarray:
    """[class * PERIOD + step]: the steps from there until the walker has moved on."""
    moves = (_random(CLASSES * PERIOD, 1) >> np.uint64(40) & np.uint64(1)).reshape(CLASSES, PERIOD)
    steps, ahead = np.zeros((CLASSES, PERIOD), np.int64), np.full(CLASSES, 10**6)
    for at in range(2 * PERIOD - 1, -1, -1):
        ahead = np.where(moves[:, at % PERIOD] == 1, 1, ahead + 1)
        steps[:, at % PERIOD] = ahead
    return np.minimum(steps, 255).astype(np.uint8).ravel()


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """The bit of each character class at each sample, and each sample's steps by length.

    The place of the least of L random numbers changes at record times only; the
    next one after r exceeds m with probability r / m.
    """
    bits = (_random(BITS * CLASSES, 2) >> np.uint64(41) & np.uint64(1)).astype(np.uint8)
    records = np.ones((BITS, 1), np.int64)
    while records[:, -1].min() < LONGEST:
        chance = (_random(BITS, 100 + records.shape[1]) >> np.uint64(11)).astype(float) / 2**53
        grown = np.minimum(records[:, -1] / np.maximum(chance, 1e-12), 4.0 * LONGEST)
        records = np.column_stack([records, np.floor(grown).astype(np.int64) + 1])
    return bits.reshape(BITS, CLASSES), records


def classes(text: str) -> np.ndarray:
    """The class of each code point, one byte each."""
    parts = []
    for at in range(0, len(text), 1 << 20):
        raw = text[at : at + (1 << 20)].encode("utf-32-le", "surrogatepass")
        parts.append((np.frombuffer(raw, np.uint32) * np.uint32(0x9E3779B1) >> np.uint32(24)).astype(np.uint8))
    return np.concatenate(parts) if parts else np.zeros(0, np.uint8)


def walks(texts: list[np.ndarray], begin: list[int]) -> list[np.ndarray]:
    """For each text, given the step it begins at, the steps spent on each character."""
    if not texts:
        return []
    stays, mask = _stays(), PERIOD - 1
    lengths = np.array([len(t) for t in texts])
    order = np.argsort(-lengths, kind="stable")
    flat = np.concatenate([texts[i] for i in order]) if lengths.sum() else np.zeros(0, np.uint8)
    spent = np.empty(len(flat), np.uint8)
    sorted_lengths = lengths[order]
    ends = np.cumsum(sorted_lengths)
    starts = ends - sorted_lengths
    at, step = starts.copy(), np.array(begin, np.int64)[order]
    side_by_side = int(sorted_lengths[LANES - 1]) if len(texts) >= LANES else 0
    live = np.searchsorted(-sorted_lengths, -np.arange(side_by_side), side="left").tolist()
    for n in live:  # all texts that are longer than the characters walked so far
        here = at[:n]
        cell = flat[here].astype(np.int64) * PERIOD + (step[:n] & mask)
        took = stays[cell]
        spent[here] = took
        step[:n] += took
        here += 1
    rows = [r.tobytes() for r in stays.reshape(CLASSES, PERIOD)]
    for i in np.flatnonzero(sorted_lengths > side_by_side).tolist():
        now, out = int(step[i]), bytearray()
        for c in flat[at[i] : ends[i]].tobytes():
            took = rows[c][now & mask]
            out.append(took)
            now += took
        spent[at[i] : ends[i]] = np.frombuffer(out, np.uint8)
    parts = dict(zip(order.tolist(), zip(starts.tolist(), ends.tolist(), strict=True), strict=True))
    return [spent[slice(*parts[i])] for i in range(len(texts))]


def fingerprint(codes: np.ndarray, spent: np.ndarray) -> np.ndarray:
    """The packed bits sampled from a walk."""
    if not len(codes):
        return np.zeros(BITS // 8, np.uint8)
    bits, records = _tables()
    sums = np.add.reduceat(spent, np.arange(0, len(spent), PIECE), dtype=np.int64)
    ends = np.cumsum(sums)
    last = (records <= ends[-1]).sum(axis=1) - 1
    steps = records[np.arange(BITS), last] - 1
    piece = np.searchsorted(ends, steps, side="right")
    read = np.empty(BITS, np.int64)
    for p in np.unique(piece).tolist():
        mine = piece == p
        inside = np.cumsum(spent[p * PIECE : (p + 1) * PIECE], dtype=np.int64)
        read[mine] = p * PIECE + np.searchsorted(inside, steps[mine] - (ends[p] - sums[p]), side="right")
    return np.packbits(bits[np.arange(BITS), codes[read]])


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of equal bits."""
    return 1.0 - int(np.bitwise_count(a ^ b).sum()) / BITS


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as many characters of the start of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _describe(texts: list[str]) -> list[tuple[int, str, str, str, float, float]]:
    """What the operator returns for each text but the last, each followed by the next."""
    codes = [classes(t) for t in texts]
    spent = walks(codes, [0] * len(codes))
    prints = [fingerprint(c, s) for c, s in zip(codes, spent, strict=True)]
    halves = [len(t) // 2 for t in texts[:-1]]
    kept = [len(t) - h for t, h in zip(texts, halves)]
    tails = [codes[i + 1][:h] for i, h in enumerate(halves)]
    reached = [int(spent[i][:k].sum(dtype=np.int64)) for i, k in enumerate(kept)]
    rows = []
    for i, more in enumerate(walks(tails, reached)):
        k = kept[i]
        changed = fingerprint(
            np.concatenate([codes[i][:k], tails[i]]), np.concatenate([spent[i][:k], more])
        )
        whole = edited(texts[i], texts[i + 1]).encode("utf-8", "surrogatepass")
        rows.append(
            (
                len(texts[i]),
                hashlib.sha256(whole).hexdigest(),
                prints[i].tobytes().hex(),
                changed.tobytes().hex(),
                likeness(prints[i], changed),
                likeness(prints[i], prints[i + 1]),
            )
        )
    return rows


RESULT = (
    "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _rows(ids: list, found: list[tuple], kind: pa.DataType, schema: list[str]) -> pa.RecordBatch:
    columns = [pa.array(ids, kind)]
    types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    columns += [pa.array([row[i] for row in found], t) for i, t in enumerate(types)]
    return pa.RecordBatch.from_arrays(columns, names=schema)


def _text(packed: bytes) -> str:
    return zstandard.ZstdDecompressor().decompress(packed).decode("utf-8", "replace")


def _key(doc_id, content: int) -> tuple:
    return (doc_id is not None, 0 if doc_id is None else doc_id, content)


def embed(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: fingerprints of the text and of its edited form.

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next. The next document is the next row by doc_id (rows without one come first),
    then by a hash of the text; the last row is followed by the first, a single row by
    itself. A null text is empty; texts of any length are read whole. Of rows that
    repeat a doc_id and text, each is followed by the next of them. Columns other than
    doc_id and text are ignored, and an empty table gives no rows.

    Rows are cut into blocks of neighbours by boundaries from a sample of the keys, and
    each block also gets the first row of the next one, so the texts are shuffled once,
    compressed. Rows that are repeated more often than a block holds take part once;
    their copies, which follow themselves, are added after.
    """
    rows = fields(docs, "doc_id", "text").select(
        "doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("content"), "text"
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    keys = stored(rows.groupBy("doc_id", "content").agg(F.count("*").alias("n")), "document-keys")
    total = keys.agg(F.sum("n")).first()[0] or 0
    wanted = max(1, min(BLOCKS, total // block))
    hot = max(block, total // BLOCKS)
    many = keys.where(F.col("n") > hot)
    crowded = {_key(r[0], r[1]) for r in many.select("doc_id", "content").collect()}  # BLOCKS at most
    sample = sorted(_key(*r) for r in hash_sample(keys.select("doc_id", "content"), 8 * wanted, "doc_id", "content").collect())
    bounds = sample[len(sample) // wanted :: max(1, len(sample) // wanted)]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            found = [bisect_right(bounds, _key(*p)) for p in pairs]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.int32()), batch.column(0), batch.column(1)], names=["block", "doc_id", "content"]
            )

    heads = (
        keys.select("doc_id", "content")
        .mapInArrow(cut, f"block int, doc_id {kind}, content bigint")
        .groupBy("block")
        .agg(F.min(F.struct("doc_id", "content")).alias("head"))
        .orderBy("block")
        .collect()
    )
    blocks = [r["block"] for r in heads]
    guests = {_key(*r["head"]): blocks[i - 1] for i, r in enumerate(heads)}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            ids, contents = (batch.column(i).to_pylist() for i in (0, 1))
            texts = batch.column(2).cast(pa.binary())
            taken, into, guest, packed = [], [], [], []
            for i, (doc_id, content) in enumerate(zip(ids, contents, strict=True)):
                key = _key(doc_id, content)
                if key in crowded and not batch.column(3)[i].as_py():
                    continue
                small = pack(texts[i].as_py() or b"")
                places = [(bisect_right(bounds, key), False)]
                if key in guests:
                    places.append((guests[key], True))
                for place, visits in places:
                    taken.append(i), into.append(place), guest.append(visits), packed.append(small)
                if len(packed) >= 2048:
                    yield dealt_rows(batch, taken, into, guest, packed)
                    taken, into, guest, packed = [], [], [], []
            if packed:
                yield dealt_rows(batch, taken, into, guest, packed)

    def dealt_rows(batch, taken, into, guest, packed) -> pa.RecordBatch:
        chosen = batch.select([0, 1]).take(pa.array(taken, pa.int64()))
        return pa.RecordBatch.from_arrays(
            [pa.array(into, pa.int32()), pa.array(guest), *chosen.columns, pa.array(packed, pa.binary())],
            names=["block", "guest", "doc_id", "content", "packed"],
        )

    names = ["doc_id", *(c.split()[0] for c in RESULT.split(", "))]

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size, place, over = [], [], 0, None, False
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            columns = [batch.column(c).to_pylist() for c in ("block", "guest", "doc_id")]
            packed = batch.column("packed")
            for i, (at, visits, doc_id) in enumerate(zip(*columns, strict=True)):
                if at != place:
                    ids, texts, size, place, over = [], [], 0, at, False
                if over:
                    continue  # a guest that repeats the one before
                text = _text(packed[i].as_py())
                ids.append(doc_id), texts.append(text)
                size, over = size + len(text), visits
                if visits or size >= TOGETHER or len(texts) > 4096:
                    if len(texts) > 1:
                        yield _rows(ids[:-1], _describe(texts), id_type, names)
                    ids, texts, size = ids[-1:], texts[-1:], len(text)

    once = rows.withColumn("single", F.lit(False))
    if crowded:
        held = F.broadcast(many.select(F.col("doc_id").alias("of"), F.col("content").alias("same"), "n"))
        same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("content") == F.col("same"))
        singles = stored(
            rows.join(held, same).groupBy("doc_id", "content").agg(F.first("text").alias("text"), F.first("n").alias("n")),
            "repeated-rows",
        )
        once = once.unionByName(singles.drop("n").withColumn("single", F.lit(True)))
    dealt = once.mapInArrow(
        deal, f"block int, guest boolean, doc_id {kind}, content bigint, packed binary"
    )
    arranged = dealt.repartition("block").sortWithinPartitions("block", "guest", F.asc_nulls_first("doc_id"), "content")
    result = arranged.mapInArrow(follow, f"doc_id {kind}, {RESULT}")
    if not crowded:
        return result

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
                whole = (text or b"").decode("utf-8", "replace")
                one = _rows([batch.column("doc_id")[i].as_py()], _describe([whole, whole]), batch.schema.field("doc_id").type, names)
                yield one.append_column("n", batch.column("n").slice(i, 1))

    copies = singles.repartition("doc_id", "content").mapInArrow(alone, f"doc_id {kind}, {RESULT}, n bigint")
    parts = F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 2) / block))
    spread = copies.withColumn("part", F.explode(parts)).repartition(F.col("part"), "doc_id", "fingerprint")
    left = F.least(F.lit(block).cast("long"), F.col("n") - 1 - F.col("part") * block)
    again = spread.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), left)))
    return result.unionByName(again.select(*names))


def spanning(prints: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that join each component of near fingerprints in one bucket, at most one per row.

    A row already reached is compared with the rows not yet reached only, so a group
    of copies costs one pass over it.
    """
    waiting, found = np.arange(len(prints)), []
    while len(waiting) > 1:
        front, waiting = [int(waiting[0])], waiting[1:]
        while front and len(waiting):
            center = front.pop()
            near = np.bitwise_count(prints[waiting] ^ prints[center]).sum(axis=1) <= distance
            reached = waiting[near].tolist()
            found += [(center, r) for r in reached]
            front += reached
            waiting = waiting[~near]
    return found


def links(prints: DataFrame, distance: int = DISTANCE, crowd: int = CROWD) -> DataFrame:
    """(a, b): links whose components are those of all links, over distinct fingerprints.

    ``prints`` has the column fingerprint. Buckets of more than ``crowd`` fingerprints are
    cut into parts, and all pairs of parts meet.
    """
    digits, bands = BITS // 4, distance + 1
    cuts = [round(i * digits / bands) for i in range(bands + 1)]
    keys = F.array(*[F.substring("fingerprint", a + 1, b - a) for a, b in zip(cuts, cuts[1:])])
    banded = prints.select(
        F.unhex("fingerprint").alias("bits"), F.posexplode(keys).alias("band", "part_bits")
    ).select("bits", F.col("band").cast("tinyint").alias("band"), F.conv("part_bits", 16, 10).cast("long").alias("key"))
    shared = (
        banded.groupBy("band", "key")
        .count()
        .where("count > 1")
        .select(
            F.col("band").alias("of"),
            F.col("key").alias("same"),
            F.ceil(F.col("count") / crowd).cast("int").alias("parts"),
        )
    )
    mine = F.pmod(F.xxhash64("bits"), F.col("parts")).cast("int")
    cells = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda other: F.least(mine, other) * F.col("parts") + F.greatest(mine, other),
    )
    dealt = (
        banded.join(shared, (F.col("band") == F.col("of")) & (F.col("key") == F.col("same")))
        .select("band", "key", F.explode(cells).alias("cell"), "bits")
        .repartition("band", "key", "cell")
        .sortWithinPartitions("band", "key", "cell", "bits")
    )

    def meet(held: list[list]) -> pa.RecordBatch:
        places, raw = list(zip(*held[:3], strict=True)), held[3]
        new = [i for i in range(len(raw)) if not i or places[i] != places[i - 1]] + [len(raw)]
        a, b = [], []
        for start, end in zip(new, new[1:]):
            words = np.frombuffer(b"".join(raw[start:end]), np.uint64).reshape(end - start, -1)
            for x, y in spanning(words, distance):
                a.append(raw[start + x].hex()), b.append(raw[start + y].hex())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string())], names=["a", "b"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[], [], [], []]
        for batch in batches:
            held = [h + c.to_pylist() for h, c in zip(held, batch.columns, strict=True)]
            if len(held[0]) >= BATCH:  # the last cell may go on in the next batch
                cut = len(held[0])
                last = [h[-1] for h in held[:3]]
                while cut and [h[cut - 1] for h in held[:3]] == last:
                    cut -= 1
                if cut:
                    yield meet([h[:cut] for h in held])
                    held = [h[cut:] for h in held]
        if held[0]:
            yield meet(held)

    return dealt.mapInArrow(compare, "a string, b string")


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, crowd: int = CROWD) -> DataFrame:
    """The rows of ``embed`` with component_id, the smallest doc_id that links reach, itself included.

    Fingerprints link when at most ``distance`` bits differ; equal ones are handled
    once. A row without doc_id names no component unless all others in it lack one
    as well (then it is null).
    """
    found = stored(embed(docs), "edit-fingerprints")
    first = stored(found.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "distinct-edit-fingerprints")
    rooted = components(links(first.select("fingerprint"), distance, crowd))
    labelled = first.join(rooted, first["fingerprint"] == rooted["node"], "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("root"), "first"
    )
    least = labelled.groupBy("root").agg(F.min("first").alias("component_id"))
    named = labelled.join(least, "root").select(F.col("fingerprint").alias("of"), "component_id")
    return found.join(named, F.col("fingerprint") == F.col("of")).drop("of")
