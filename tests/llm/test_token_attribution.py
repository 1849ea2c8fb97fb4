from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.brute import AWKWARD, awkward, documents
from tidegate.llm import token_attribution as ta

with open(ta.VOCABULARY, "rb") as file:
    ENCODER, _ = ta.encoder(file.read(), ta.PATTERN)


def expected(texts, rule):
    """Each byte's section, and each token's share of them, one byte at a time."""
    owner, spans = [], []
    place = 0
    for f, text in enumerate(texts):
        lines = text.split("\n")
        for n, line in enumerate(lines):
            tail = "\n" if n < len(lines) - 1 else ta.SEPARATOR if f < len(texts) - 1 else ""
            whole = line + tail
            spans.append((f, n, place, place + len(whole)))
            owner += [len(spans) - 1] * len(whole.encode())
            place += len(whole)
    tokens, crossing, at = Counter(), Counter(), 0
    for token in ENCODER.encode_ordinary(ta.SEPARATOR.join(texts)):
        size = len(ENCODER.decode_single_token_bytes(token))
        held = owner[at : at + size]
        best = held[0] if rule == "start" else max(sorted(set(held)), key=held.count)
        tokens[best] += 1
        crossing[best] += len(set(held)) > 1
        at += size
    assert at == len(owner)
    return [(*s, tokens[i], crossing[i]) for i, s in enumerate(spans)]


def run(rows, rule):
    names = ("field", "section", "char_start", "char_end", "n_tokens", "n_crossing")
    return sorted(tuple(r[n] for n in ("doc_id", *names)) for r in rows)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab é\n\t漢🙂.", max_size=12), min_size=1, max_size=3), st.sampled_from(ta.RULES))
def test_allocation_equals_bytewise(texts, rule):
    whole, spans = ta.sections(texts)
    lengths = [len(ENCODER.decode_single_token_bytes(t)) for t in ENCODER.encode_ordinary(whole)]
    starts = np.array([len(whole[: s[2]].encode()) for s in spans])
    n, c = ta.allocate(np.cumsum(np.array(lengths, np.int64)), starts, len(whole.encode()), rule)
    assert [(*s, a, b) for s, a, b in zip(spans, n.tolist(), c.tolist(), strict=True)] == expected(texts, rule)


@pytest.mark.parametrize("rule", ta.RULES)
def test_whole_table(spark, rule):
    docs = documents(spark)
    got = run(ta.attribute(docs, ["source", "text"], rule).collect(), rule)
    want = []
    for r in docs.select("doc_id", "source", "text").collect():
        for row in expected([r.source or "", r.text or ""], rule):
            want.append((r.doc_id, ["source", "text"][row[0]], *row[1:]))
    assert got == sorted(want)


def test_awkward_rows(spark):
    got = ta.attribute(awkward(spark), ["source", "text"]).collect()
    want = [expected([row[3] or "", row[1] or ""], "start") for row in AWKWARD]
    assert len(got) == sum(map(len, want))
    assert sum(r.n_tokens for r in got) == sum(x[4] for rows in want for x in rows)
    assert ta.attribute(awkward(spark, empty=True), ["text"]).collect() == []
    with pytest.raises(ValueError):
        ta.attribute(awkward(spark), ["text"], rule="end")
