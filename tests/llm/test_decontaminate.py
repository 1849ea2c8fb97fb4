import hashlib
import random

import pytest

from tests.llm.brute import AWKWARD, SF_DIR, awkward, bench_words, documents
from tidegate.llm import decontaminate as dc


def expected(rows, items, window=13):
    grams = {}
    for item_id, text in items:
        tokens = bench_words(text)
        size = min(window, len(tokens))
        for i in range(len(tokens) - size + 1 if size else 0):
            grams.setdefault(tuple(tokens[i : i + size]), set()).add(item_id)
    out = []
    for doc_id, text in rows:
        tokens, hit, found = bench_words(text), set(), set()
        for size in {len(g) for g in grams}:
            for i in range(len(tokens) - size + 1):
                if (ids := grams.get(tuple(tokens[i : i + size]))) is not None:
                    hit |= set(range(i, i + size))
                    found |= ids
        names = sorted(str(i) for i in found if i is not None)
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        dirty = bool(hit) and 20 * len(hit) >= len(tokens)
        out.append((doc_id, len(tokens), len(hit), len(names), digest, dirty, sorted(hit)))
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


def pairs(df, *names):
    return [tuple(r) for r in df.select(*names).collect()]


@pytest.mark.parametrize("most", [0, dc.BROADCAST_WINDOWS])
def test_whole_table(spark, most):
    docs, items = documents(spark), spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    want = expected(pairs(docs, "doc_id", "text"), pairs(items, "item_id", "text"))
    assert sum(r[5] for r in want) > 3
    assert found(dc.contamination(docs, items, broadcast_windows=most)) == want


@pytest.mark.parametrize("most", [0, dc.BROADCAST_WINDOWS])
def test_awkward_rows(spark, most):
    schema = "item_id bigint, text string"
    items = [
        (1, "THE cat, sat!"), (2, None), (3, ""), (4, "word " * 20), (4, "one"), (None, "É-è"),
        (10, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13 w14"), (9, "w3 w4 w5"), (1, "w3 w4 w5"),
    ]
    benchmark = spark.createDataFrame(items, schema)
    rows = [row[:2] for row in AWKWARD]
    def judged(docs, items):
        return found(dc.contamination(docs, items, broadcast_windows=most))

    assert judged(awkward(spark), benchmark) == expected(rows, items)
    assert judged(awkward(spark), benchmark.limit(0)) == expected(rows, [])
    assert judged(awkward(spark, empty=True), benchmark) == []


def test_case_folds_for_a_to_z_only(spark):
    rows = [(1, "ÉCOLE é KK x"), (2, "école É kk X"), (3, "ÉCOLE É KK X")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    items = [(7, "École É kk x")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    got = found(dc.contamination(docs, benchmark))
    assert got == expected(rows, items) and [r[5] for r in got] == [False, False, True]


def test_windows_with_equal_samples_are_verified(spark):
    rng = random.Random(4)
    item = [f"v{rng.randrange(3)}" for _ in range(40)]
    rows = []
    for i in range(80):
        a = rng.randrange(27)
        copy = item[a : a + 13]
        copy[rng.randrange(13)] = rng.choice(["v0", "v1", "v2", "v3"])
        rows.append((i, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string")
    assert found(dc.contamination(docs, benchmark)) == expected(rows, [(1, " ".join(item))])


def shuffled(df):
    """The types of the columns of all shuffles in the plan of ``df``."""
    types = []
    plan = df._jdf.queryExecution().executedPlan()
    todo = [plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan]
    while todo:
        node = todo.pop()
        if node.nodeName() == "Exchange":
            out = node.output()
            types.append({out.apply(i).name(): out.apply(i).dataType().simpleString() for i in range(out.size())})
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return types


def test_the_shuffle_form_moves_no_token_arrays(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs, items = documents(spark), spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
        result = dc.contamination(docs, items, broadcast_windows=0)
        moved = shuffled(result)
        assert len(moved) >= 6
        assert not [m for m in moved if "tokens" in m]
        windows = [m for m in moved if {"at", "key"} <= set(m) and "seen" not in m]  # the one length is a literal
        assert windows and all("text" not in m for m in windows)
        assert found(result) == expected(pairs(docs, "doc_id", "text"), pairs(items, "item_id", "text"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_window_that_many_items_share_is_one_row(spark):
    text = " ".join(f"w{i}" for i in range(13))
    benchmark = spark.createDataFrame([(i, text) for i in range(500)], "item_id bigint, text string")
    assert [len(r["items"]) for r in dc.benchmark_windows(benchmark).collect()] == [500]
    docs = spark.createDataFrame([(1, text), (1, text), (None, text), (2, "x " + text)], "doc_id bigint, text string")
    rows, items = pairs(docs, "doc_id", "text"), pairs(benchmark, "item_id", "text")
    for most in (0, 10):
        assert found(dc.contamination(docs, benchmark, broadcast_windows=most)) == expected(rows, items)


def test_many_bytes_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(dc, "BROADCAST_BYTES", 10)
    monkeypatch.setattr(dc, "_hits_by_broadcast", None)
    rows, items = [(1, "a b c"), (2, "d")], [(1, "b c")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    assert found(dc.contamination(docs, benchmark)) == expected(rows, items)
