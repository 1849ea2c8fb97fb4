import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.brute import AWKWARD, awkward, documents, words
from tidegate.llm import substring_dedup as sd
from tidegate.llm.suffix_automata import SuffixAutomaton


def expected(rows, window=13):
    first, out = {}, []
    for doc_id, text in rows:
        tokens = words(text)
        for i in range(len(tokens) - window + 1):
            key = tuple(tokens[i : i + window])
            if doc_id is not None:
                first[key] = min(doc_id, first.get(key, doc_id))
    for doc_id, text in rows:
        tokens = words(text)
        gone = set()
        for i in range(len(tokens) - window + 1):
            if doc_id is not None and first[tuple(tokens[i : i + window])] < doc_id:
                gone |= set(range(i, i + window))
        kept = " ".join(t for i, t in enumerate(tokens) if i not in gone)
        out.append((doc_id, len(tokens), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="abc", max_size=20), max_size=4), st.text(alphabet="abcd", max_size=30))
def test_matching_statistics(reference, text):
    automaton = SuffixAutomaton()
    for r in reference:
        automaton.add(r)
    want = [
        max((n for n in range(i + 2) if any(text[i + 1 - n : i + 1] in r for r in reference)), default=0)
        for i in range(len(text))
    ]
    assert automaton.statistics(text) == want


def test_word_hashes_tell_words_apart():
    texts = [b"ab ba  a\tb ab", b"", b"ab " + "é".encode() * 700_000 + b" x" * 700_000]
    parts = sd.Texts(texts, 13, 5)
    spelled = [parts.bytes[a:b] for a, b in zip(parts.starts, parts.ends, strict=True)]
    assert spelled == [w for t in texts for w in t.split()]
    assert len(set(parts.hashes.tolist())) == len(set(spelled))
    assert parts.owner.tolist() == [i for i, t in enumerate(texts) for _ in t.split()]


def test_equal_windows_have_equal_anchors():
    rng = random.Random(3)
    passage = [f"p{rng.randrange(50)}" for _ in range(40)]
    seen = {}
    for _ in range(30):
        before, after = ([f"q{rng.random()}" for _ in range(rng.randrange(20))] for _ in range(2))
        t = sd.Texts([" ".join(before + passage + after).encode()], 13, 5)
        for anchor, at, n in zip(t.anchors.tolist(), t.at.tolist(), t.count.tolist(), strict=True):
            for i in range(n):
                key = t.text(at + i, 1)
                assert seen.setdefault(key, anchor) == anchor


def test_whole_table(spark):
    docs = documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = expected(rows)
    assert sum(r[2] for r in want) > 1_000
    assert found(sd.deduplicate(docs)) == want


@pytest.mark.parametrize("hot", [0, 3, 10**9])
def test_planted_passages(spark, hot):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(30)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randrange(10, 60))] for _ in range(8)]
    rows = []
    for i in range(150):
        tokens = []
        for _ in range(rng.randrange(4)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            tokens += p[a : rng.randrange(a, len(p)) + 1] if rng.random() < 0.7 else p
            tokens += [rng.choice(vocabulary) for _ in range(rng.randrange(6))]
        rows.append((rng.randrange(120), rng.choice([" ", "\n", "  "]).join(tokens)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert found(sd.deduplicate(docs, hot=hot)) == expected(rows)


def test_awkward_rows(spark):
    rows = [row[:2] for row in AWKWARD]
    assert found(sd.deduplicate(awkward(spark))) == expected(rows)
    assert found(sd.deduplicate(awkward(spark, empty=True))) == []


def test_repeated_rows_are_sent_once_a_batch(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text)] + [(2, text)] * 400 + [(2, text + " and more")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    read = docs.selectExpr("*", "xxhash64(text) AS content")
    sets = sd.bloom(sd.anchor_counts(read, sd.WINDOW, sd.ANCHOR), sd.HOT)
    sent = sd.stretches(read, sets, sd.WINDOW, sd.ANCHOR)
    assert 0 < sent.where("doc_id = 2").count() < 400
    assert found(sd.deduplicate(docs)) == expected(rows)
    assert found(sd.deduplicate(docs.repartition(6))) == expected(rows)


def test_against_a_broadcast_reference(spark, monkeypatch):
    monkeypatch.setattr(sd, "SHARD_WORDS", 300)
    docs = documents(spark).where("doc_id % 7 = 0")
    reference = documents(spark).where("doc_id % 7 = 1 AND doc_id < 300")
    smaller = [(0, r.text) for r in reference.select("text").collect()]
    rows = [(r.doc_id + 1, r.text) for r in docs.select("doc_id", "text").collect()]
    whole = {}
    for _, text in smaller:
        tokens = words(text)
        whole |= {tuple(tokens[i : i + 13]): None for i in range(len(tokens) - 12)}
    total = 0
    got = {r.doc_id: r.n_removed for r in sd.against_reference(docs, reference).collect()}
    for doc_id, text in rows:
        tokens, gone = words(text), set()
        for i in range(len(tokens) - 12):
            if tuple(tokens[i : i + 13]) in whole:
                gone |= set(range(i, i + 13))
        assert got[doc_id - 1] == len(gone)
        total += len(gone)
    assert total > 0
    monkeypatch.setattr(sd, "REFERENCE_WORDS", 10)
    with pytest.raises(ValueError):
        sd.against_reference(docs, reference)


def test_covered():
    assert sd.covered(6, [{"start": 1, "n": 1}, {"start": 2, "n": 1}], 3).tolist() == [0, 1, 1, 1, 1, 0]
    assert sd.spans(np.array([True, True, False, True])) == [(0, 2), (3, 1)]
