import hashlib
import random

import numpy as np
import pytest

from tests.llm.brute import AWKWARD, Union, awkward, documents
from tidegate.llm import edit_embedding as ee

MOVES = (ee._random(ee.CLASSES * ee.PERIOD, 1) >> np.uint64(40) & np.uint64(1)).tolist()
BITS, RECORDS = (t.tolist() for t in ee._tables())


def kind(c):
    return (ord(c) * 0x9E3779B1 & 0xFFFFFFFF) >> 24


def fingerprint(text):
    """The walk, step by step."""
    read, at = [], 0
    while at < len(text):
        c = kind(text[at])
        read.append(c)
        at += MOVES[c * ee.PERIOD + (len(read) - 1) % ee.PERIOD]
    bits = 0
    for b in range(ee.BITS):
        step = max((r for r in RECORDS[b] if r <= len(read)), default=0)
        bits = bits * 2 + (BITS[b][read[step - 1]] if step else 0)
    return f"{bits:064x}"


def differing(a, b):
    return (int(a, 16) ^ int(b, 16)).bit_count()


def expected(rows):
    """``rows`` in the operator's order."""
    prints = [fingerprint(t or "") for _, t in rows]
    out = []
    for i, (doc_id, text) in enumerate(rows):
        j = (i + 1) % len(rows)
        text, following = text or "", rows[j][1] or ""
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        mark = fingerprint(changed)
        out.append(
            (
                doc_id,
                len(text),
                hashlib.sha256(changed.encode()).hexdigest(),
                prints[i],
                mark,
                1 - differing(prints[i], mark) / ee.BITS,
                1 - differing(prints[i], prints[j]) / ee.BITS,
            )
        )
    return sorted(out, key=str)


def classes(rows):
    """doc_id and component of (doc_id, fingerprint) rows, pair by pair."""
    union, distinct = Union(), sorted({p for _, p in rows})
    for i, a in enumerate(distinct):
        union.root(a)
        for b in distinct[i + 1 :]:
            if differing(a, b) <= ee.DISTANCE:
                union.join(a, b)
    least = {}
    for doc_id, p in rows:
        if doc_id is not None:
            least[union.root(p)] = min(doc_id, least.get(union.root(p), doc_id))
    return sorted(((d, p, least.get(union.root(p))) for d, p in rows), key=str)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))


def test_whole_table_equals_the_walk_step_by_step(spark):
    docs = documents(spark, "/root/testdata/sf0.001")
    rows = in_order([(r.doc_id, r.text) for r in docs.collect()])
    assert found(ee.embed(docs)) == expected(rows)
    assert found(ee.embed(docs, block=7)) == expected(rows)


def test_components_equal_all_pairs(spark):
    found_rows = ee.near_duplicates(documents(spark)).select("doc_id", "fingerprint", "component_id").collect()
    want = classes([(r.doc_id, r.fingerprint) for r in found_rows])
    assert len({c for _, _, c in want}) < len(want)
    assert sorted(map(tuple, found_rows), key=str) == want


@pytest.mark.parametrize("block", [1, 1024])
def test_awkward_rows(spark, block):
    assert found(ee.embed(awkward(spark), block=block)) == expected(in_order([r[:2] for r in AWKWARD]))
    assert found(ee.embed(awkward(spark, empty=True), block=block)) == []
    assert found(ee.near_duplicates(awkward(spark, empty=True))) == []


def test_a_single_row_follows_itself(spark):
    one = spark.createDataFrame([(1, "abcdefg")], "doc_id bigint, text string")
    assert found(ee.embed(one)) == expected([(1, "abcdefg")])


def test_rows_repeated_beyond_a_block(spark):
    rows = [(None, "same words again")] * 50 + [(i, f"text number {i}") for i in range(30)] + [(40, "tail")] * 20
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found(ee.embed(df, block=4)) == expected(in_order(rows))


def test_string_ids(spark):
    rows = [(f"k{i:02d}", f"text number {i}") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    assert [r[0] for r in found(ee.embed(df, block=4))] == [r[0] for r in rows]


def test_walks_side_by_side_equal_single_ones():
    rng = random.Random(5)
    texts = ["".join(rng.choice("abc é") for _ in range(rng.randint(0, 900))) for _ in range(ee.LANES + 60)]
    codes = [ee.classes(t) for t in texts]
    together = ee.walks(codes, [7] * len(codes))
    assert all(np.array_equal(t, ee.walks([c], [7])[0]) for t, c in zip(together, codes, strict=True))


def test_long_text_is_read_in_pieces(monkeypatch):
    rng = random.Random(3)
    text = "".join(rng.choice("abcdefgh ") for _ in range(5_000))
    codes = ee.classes(text)
    spent = ee.walks([codes], [0])[0]
    whole = ee.fingerprint(codes, spent)
    monkeypatch.setattr(ee, "PIECE", 64)
    assert np.array_equal(ee.fingerprint(codes, spent), whole)


def test_few_edits_keep_fingerprints_near():
    rng = random.Random(9)
    mark = lambda t: ee.fingerprint(ee.classes(t), ee.walks([ee.classes(t)], [0])[0])
    letters = "abcdefghijklmnopqrstuvwxyz "
    near, far = [], []
    for _ in range(40):
        text = "".join(rng.choice(letters) for _ in range(3_000))
        edited = list(text)
        for _ in range(6):
            at = rng.randrange(len(edited))
            match rng.randrange(3):
                case 0:
                    del edited[at]
                case 1:
                    edited.insert(at, rng.choice(letters))
                case 2:
                    edited[at] = rng.choice(letters)
        other = "".join(rng.choice(letters) for _ in range(3_000))
        near.append(ee.likeness(mark(text), mark("".join(edited))))
        far.append(ee.likeness(mark(text), mark(other)))
    assert min(near) > max(far)
    assert sum(near) / 40 > 0.9 and sum(far) / 40 < 0.6


@pytest.mark.parametrize("crowd", [2, 2048])
def test_crowded_buckets_lose_no_link(spark, crowd):
    rng = random.Random(1)
    centre = rng.getrandbits(256)
    prints = {f"{centre ^ sum(1 << b for b in rng.sample(range(256), k)):064x}" for k in range(9) for _ in range(20)}
    prints |= {f"{rng.getrandbits(256):064x}" for _ in range(40)}
    rows = list(enumerate(sorted(prints)))
    df = spark.createDataFrame([(p,) for _, p in rows], "fingerprint string")
    linked = {tuple(r) for r in ee.links(df, crowd=crowd).collect()}
    union = Union()
    for a, b in linked:
        assert differing(a, b) <= ee.DISTANCE
        union.join(a, b)
    want = {p: c for _, p, c in classes(rows)}
    ids = {p: i for i, p in rows}
    assert {p: ids[min(q for q in prints if union.root(q) == union.root(p))] for p in prints} == want
