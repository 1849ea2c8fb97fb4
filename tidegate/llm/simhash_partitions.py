"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints of 64 bits link if at most ``DISTANCE`` bits differ. The bits are cut
into m partitions, partition i with a threshold t_i of its own; if the thresholds
sum to DISTANCE - m + 1, two linked fingerprints are within t_i in at least one
partition (t_i = -1 leaves a partition out). So:

1. one pass over all distinct fingerprints counts how often each pair of bits is set;
   correlated bits are grouped into one partition, as bits that repeat each other
   would make several partitions unselective at once;
2. for m = 2, 3, 4 the pairs that share a partition's value are counted over all
   fingerprints, and candidate counts for wider thresholds are estimated from them and
   the bits' marginals; dynamic programming allocates the thresholds at least cost,
   and the cheapest m is taken;
3. fingerprints are indexed by their partition values and probe with all values within
   t_i; candidates that meet are verified over all 64 bits, in blocks of bounded size;
4. components of the verified links give the groups.

Only numbers of fixed size come to the driver: the bit counts and candidate counts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.components import components
from tidegate.llm.frames import fields, stored

BITS = 64
SHINGLE = 3
DISTANCE = 3
SEED = 42
#: A bucket with more rows is cut into blocks of about this size, and all pairs of blocks meet.
BLOCK = 2048
#: Rows that a task verifies at a time, in whole cells.
BATCH = 100_000
#: What handing out one index or probe row costs, in verified candidates.
ROW_COST = 40.0

Plan = list[tuple[list[int], int]]


def fingerprint(data: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of the words of a UTF-8 text; without words 0."""
    tokens = data.lower().split()  # bytes: A-Z only, and ASCII white space only
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    if len(tokens) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(tokens) - shingle + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist())],
        dtype=">u8",
    )
    set_bits = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 4096):
        part = hashes[at : at + 4096].view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_bits > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): fp as a signed 64-bit number; a null text is taken as empty."""
    chosen = fields(docs, "doc_id", "text")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            found = np.array([fingerprint(t or b"", shingle) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found.view(np.int64))], names=["doc_id", "fp"]
            )

    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(of, f"doc_id {kind}, fp bigint")


def bit_counts(fps: DataFrame) -> tuple[np.ndarray, int]:
    """How many fingerprints have bits i and j set, for all i and j, and how many there are."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, rows = np.zeros((BITS, BITS)), 0
        for batch in batches:
            values = np.ascontiguousarray(batch.column(0).to_numpy()).view(np.uint64)
            bits = (values[:, None] >> np.arange(BITS, dtype=np.uint64) & np.uint64(1)).astype(float)
            both += bits.T @ bits
            rows += len(values)
        cells = np.append(both.ravel(), rows).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(cells), dtype=np.int32)), pa.array(cells)], names=["cell", "n"]
        )

    rows = fps.mapInArrow(count, "cell int, n bigint").groupBy("cell").agg(F.sum("n")).collect()
    cells = np.zeros(BITS * BITS + 1)
    for cell, n in rows:
        cells[cell] = n
    return cells[:-1].reshape(BITS, BITS), int(cells[-1])


def group_bits(both: np.ndarray, rows: int, m: int) -> list[list[int]]:
    """m groups of nearly equal size, each grown by the bit most correlated with it."""
    p = np.diag(both) / max(rows, 1)
    spread = np.sqrt(np.outer(p * (1 - p), p * (1 - p)))
    related = np.abs(both / max(rows, 1) - np.outer(p, p)) / np.where(spread > 0, spread, 1)
    np.fill_diagonal(related, 0)
    free, groups = list(range(BITS)), []
    for i in range(m):
        size = (BITS * (i + 1)) // m - (BITS * i) // m
        group = [max(free, key=lambda b: related[b, free].sum())]
        free.remove(group[0])
        while len(group) < size:
            nearest = max(free, key=lambda b: related[b, group].sum())
            group.append(nearest)
            free.remove(nearest)
        groups.append(sorted(group))
    return groups


def project(fp: Column, bits: list[int]) -> Column:
    """The chosen bits of a fingerprint, the others 0."""
    mask = sum(1 << b for b in bits)
    return fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long"))


def flips(bits: list[int], most: int) -> list[int]:
    """Every mask of 1 to ``most`` of the bits, as signed numbers."""
    masks = [sum(1 << b for b in some) for k in range(1, most + 1) for some in combinations(bits, k)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def allocate(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds -1, 0, 1, ... with the given sum and the least cost: costs[i][t + 1]."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for options in costs:
        grown: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for at, extra in enumerate(options):
                now = used + at - 1
                if now not in grown or cost + extra < grown[now][0]:
                    grown[now] = (cost + extra, [*chosen, at - 1])
        best = grown
    return best[total]


def plan_partitions(fps: DataFrame, distance: int = DISTANCE) -> Plan:
    """The cheapest (bits, threshold) partitions for these distinct fingerprints."""
    both, rows = bit_counts(fps)
    choices = {m: group_bits(both, rows, m) for m in range(2, distance + 2)}
    parts = [(m, bits) for m, groups in choices.items() for bits in groups]
    shared = (
        fps.select(
            F.posexplode(F.array(*[project(F.col("fp"), bits) for _, bits in parts]))
        )
        .groupBy("pos", "col")
        .count()
        .groupBy("pos")
        .agg(F.sum(F.col("count") * (F.col("count") - 1) / 2).alias("pairs"))
        .collect()
    )
    equal = {r["pos"]: r["pairs"] for r in shared}
    p = np.diag(both) / max(rows, 1)
    differ = 2 * p * (1 - p)
    plans = []
    for m, groups in choices.items():
        costs = []
        for bits in groups:
            pairs = equal.get(parts.index((m, bits)), 0.0)
            ratio = [differ[b] / (1 - differ[b]) for b in bits]
            wider = [1.0] + [0.0] * distance  # elementary symmetric sums
            masks = [1.0] + [0.0] * distance
            for r in ratio:
                for k in range(distance, 0, -1):
                    wider[k] += wider[k - 1] * r
                    masks[k] += masks[k - 1]
            costs.append(
                [0.0]
                + [
                    pairs * sum(wider[: t + 1]) + ROW_COST * rows * (sum(masks[: t + 1]) + (t > 0))
                    for t in range(distance + 1)
                ]
            )
        cost, chosen = allocate(costs, distance - m + 1)
        plans.append((cost, list(zip(groups, chosen, strict=True))))
    return min(plans, key=lambda x: x[0])[1]


def _prober(part: int, value: Column) -> Callable[[Column], Column]:
    return lambda mask: F.struct(
        F.lit(part).alias("part"),
        value.bitwiseXOR(mask).alias("key"),
        F.lit(True).alias("probe"),
    )


def _signatures(fps: DataFrame, plan: Plan) -> DataFrame:
    """(part, key, fp, probe): each fingerprint's index row and its probes, in each partition."""
    rows = []
    for part, (bits, most) in enumerate(plan):
        if most < 0:
            continue
        value = project(F.col("fp"), bits)
        rows.append(
            F.array(F.struct(F.lit(part).alias("part"), value.alias("key"), F.lit(False).alias("probe")))
        )
        if most:
            masks = F.array(*[F.lit(x).cast("long") for x in flips(bits, most)])
            rows.append(F.transform(masks, _prober(part, value)))
    return fps.select("fp", F.inline(F.concat(*rows)))


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n rows the smallest row of its component."""
    root = np.arange(n)
    while True:
        least = np.minimum(root[a], root[b])
        now = root.copy()
        np.minimum.at(now, a, least)
        np.minimum.at(now, b, least)
        now = now[now]
        if np.array_equal(now, root):
            return root
        root = now


def verified(cell: np.ndarray, fp: np.ndarray, probe: np.ndarray, distance: int) -> np.ndarray:
    """(fp, fp) links that span the components within cells; rows come sorted by cell.

    Every candidate pair is compared, but only a spanning set of links is kept:
    at most one for each row.
    """
    n, a, b, waiting = len(fp), [], [], 0
    root = np.arange(n)
    for shift in range(1, n):
        at = np.flatnonzero(cell[shift:] == cell[:-shift])
        if not len(at):
            break  # rows of a cell are adjacent
        near = np.bitwise_count(fp[at] ^ fp[at + shift]) <= distance
        near &= ~(probe[at] & probe[at + shift])
        at = at[near]
        a.append(at)
        b.append(at + shift)
        waiting += len(at)
        if waiting > 1_000_000:
            a.append(np.arange(n)), b.append(root)
            root = _roots(n, np.concatenate(a), np.concatenate(b))
            a, b, waiting = [], [], 0
    if a:
        root = _roots(n, np.concatenate([*a, np.arange(n)]), np.concatenate([*b, root]))
    linked = np.flatnonzero(fp != fp[root])
    return np.unique(np.stack([fp[linked], fp[root[linked]]], axis=1), axis=0)


def links(fps: DataFrame, plan: Plan, distance: int = DISTANCE, block: int = BLOCK) -> DataFrame:
    """(a, b): verified links whose components are those of all links, over distinct fingerprints."""
    signed = _signatures(fps, plan)
    crowded = (
        signed.groupBy("part", "key")
        .count()
        .where(F.col("count") > block)
        .select("part", "key", F.ceil(F.col("count") / block).cast("int").alias("blocks"))
    )
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    cells = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.least(mine, other) * F.col("blocks") + F.greatest(mine, other),
    )
    dealt = (
        signed.join(crowded, ["part", "key"], "left")
        .select(
            "part",
            "key",
            F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(cells)).alias("cell"),
            "fp",
            "probe",
        )
        .repartition("part", "key", "cell")
        .sortWithinPartitions("part", "key", "cell")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(held: list[np.ndarray]) -> pa.RecordBatch:
            part, key, cell, fp, probe = held
            new = np.ones(len(fp), bool)
            new[1:] = (part[1:] != part[:-1]) | (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])
            found = verified(np.cumsum(new), fp.view(np.uint64), probe, distance).view(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"]
            )

        held: list[np.ndarray] = []
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            held = [np.concatenate(x) for x in zip(held, columns)] if held else columns
            if len(held[0]) >= BATCH:
                last = [h[-1] for h in held[:3]]
                same = (held[0] == last[0]) & (held[1] == last[1]) & (held[2] == last[2])
                cut = int(np.argmax(same))  # the last cell may go on in the next batch
                if cut:
                    yield out([h[:cut] for h in held])
                    held = [h[cut:] for h in held]
        if held and len(held[0]):
            yield out(held)

    return dealt.mapInArrow(compare, "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, block: int = BLOCK
) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest doc_id that links reach, the document's own
    included. Null and empty texts have fingerprint zero and link like any other.
    Equal fingerprints are handled once, so copies make no pairs. Rows without
    doc_id get an answer too, but name no component unless all others in it lack
    one as well (then it is null). Repeated rows get equal answers. Columns other
    than doc_id and text are ignored; an empty table gives no rows.
    """
    hashed = stored(fingerprints(docs, shingle), "fingerprints")
    first = stored(hashed.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    fps = first.select("fp")
    plan = plan_partitions(fps, distance)
    rooted = components(links(fps, plan, distance, block))
    labelled = first.join(rooted, first["fp"] == rooted["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first"
    )
    least = labelled.groupBy("root").agg(F.min("first").alias("component_id"))
    named = labelled.join(least, "root").select(F.col("fp").alias("of"), "component_id")
    return hashed.join(named, F.col("fp") == F.col("of")).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )
