import random

import pytest
import xxhash

from tests.llm.brute import AWKWARD, Union, ascii_lower, awkward, documents, words
from tidegate.llm import components as cc
from tidegate.llm import simhash_partitions as sp


def fingerprint(text):
    tokens = words(ascii_lower(text))
    grams = [tokens[i : i + 3] for i in range(len(tokens) - 2)] or ([tokens] if tokens else [])
    hashes = [xxhash.xxh64_intdigest(" ".join(g).encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def expected(rows):
    fps = [(doc_id, fingerprint(text)) for doc_id, text in rows]
    union, distinct = Union(), sorted({fp for _, fp in fps})
    for i, a in enumerate(distinct):
        union.root(a)
        for b in distinct[i + 1 :]:
            if (a ^ b).bit_count() <= 3:
                union.join(a, b)
    least = {}
    for doc_id, fp in fps:
        if doc_id is not None:
            root = union.root(fp)
            least[root] = min(doc_id, least.get(root, doc_id))
    return sorted(
        ((d, f"{fp:016x}", least.get(union.root(fp))) for d, fp in fps), key=str
    )


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_whole_table_equals_brute_force(spark):
    docs = documents(spark)
    want = expected([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert len({c for _, _, c in want}) < len(want)
    assert found(sp.near_duplicates(docs)) == want


def test_awkward_rows(spark):
    want = expected([row[:2] for row in AWKWARD])
    assert found(sp.near_duplicates(awkward(spark))) == want
    assert found(sp.near_duplicates(awkward(spark, empty=True))) == []


@pytest.mark.parametrize(
    "thresholds", [(0, 0, 0, 0), (1, 0, 0, -1), (1, 0, 0), (2, 0, -1), (1, 1), (3, -1), (0, 2)]
)
def test_no_link_is_lost_whatever_the_thresholds(spark, thresholds):
    rng = random.Random(7)
    values = set()
    for _ in range(60):
        centre = rng.getrandbits(64)
        for _ in range(12):
            x = centre
            for _ in range(rng.randrange(6)):
                x ^= 1 << rng.randrange(64)
            values.add(x)
    signed = [x - (1 << 64) if x >> 63 else x for x in values]
    fps = spark.createDataFrame([(x,) for x in signed], "fp bigint")
    m = len(thresholds)
    bits = list(range(64))
    rng.shuffle(bits)
    plan = [(sorted(bits[i::m]), t) for i, t in enumerate(thresholds)]
    union = Union()
    ordered = sorted(values)
    for i, a in enumerate(ordered):
        for b in ordered[i + 1 :]:
            if (a ^ b).bit_count() <= 3:
                union.join(a, b)
    linked = Union()
    for a, b in sp.links(fps, plan, block=5).collect():
        a, b = a % (1 << 64), b % (1 << 64)
        assert (a ^ b).bit_count() <= 64
        linked.join(a, b)
    assert [union.root(x) for x in ordered] == [linked.root(x) for x in ordered]


def test_thresholds_sum_and_cost():
    cost, chosen = sp.allocate([[0, 5, 9, 20, 40], [0, 1, 2, 4, 8]], 2)
    assert sum(chosen) == 2 and (cost, chosen) == (8, [-1, 3])


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (None, 3)]
    got = dict(map(tuple, cc.components(spark.createDataFrame(edges, "x bigint, y bigint")).collect()))
    assert got == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 160)}
