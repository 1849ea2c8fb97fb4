import math
import re
from collections import Counter

import numpy as np
import pytest

from tests.compare import spark_bag, sql_bag
from tests.llm.brute import AWKWARD, SF_DIR, ascii_lower, awkward, documents
from tidegate.llm import dual_tree_search as dt
from tidegate.llm import queries


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", ascii_lower(text))


def expected(rows, items, k=50):
    cut = [(d, Counter(terms(t))) for d, t in rows]
    cut = [(d, c) for d, c in cut if c]
    total, length = len(cut), sum(sum(c.values()) for _, c in cut)
    df = Counter(t for _, c in cut for t in c)
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, wanted in asked.items():
        scores = []
        for doc_id, c in cut:
            m = 100 - 50 + 50 * sum(c.values()) * total // length
            s = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1)))
                * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m))
                for t in wanted & c.keys()
            )
            if s > 0:
                scores.append((-s, doc_id is None, doc_id))
        scores.sort(key=lambda r: (r[0], r[1], r[2] or 0))
        out += [(item, i, d, -s) for i, (s, _, d) in enumerate(scores[:k], 1)]
    return sorted(out, key=str)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


def tables(spark):
    benchmark = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    return documents(spark), benchmark, [tuple(r) for r in benchmark.select("item_id", "text").collect()]


def test_query_equals_sql(spark):
    name = "op12_dual_tree_search"
    assert spark_bag(queries.QUERIES[name](spark, SF_DIR)) == sql_bag(SF_DIR, queries.ORACLES[name])


@pytest.mark.parametrize("k, pairs", [(50, dt.PAIRS), (3, 200)])
def test_whole_table_equals_brute_force(spark, k, pairs):
    docs, benchmark, items = tables(spark)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert found(dt.rank(docs, benchmark, k=k, pairs=pairs)) == expected(rows, items, k)


@pytest.mark.parametrize("items, cells", [(1, 50), (9, 100_000), (40, 8_000_000)])
def test_any_size_of_trees_and_blocks(spark, monkeypatch, items, cells):
    monkeypatch.setattr(dt, "ITEMS", items)
    monkeypatch.setattr(dt, "CELLS", cells)
    docs, benchmark, wanted = tables(spark)
    docs = docs.where("doc_id < 300")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert found(dt.rank(docs, benchmark)) == expected(rows, wanted)


def test_ties_rank_by_id(spark):
    rows = [(i, "alpha beta") for i in range(300, 0, -1)] + [(None, "alpha beta"), (0, "gamma")]
    items = [(1, "alpha"), (2, "BETA alpha"), (None, "gamma")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    assert found(dt.rank(docs, asked)) == expected(rows, items)


def test_awkward_rows(spark):
    items = [(1, "The cat, W7 w8"), (1, "one!"), (2, None), (3, ""), (4, "é x" + "x" * 199_999), (5, "555 word")]
    asked = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "'y' AS TEXT", "1 AS term")
    rows = [r[:2] for r in AWKWARD]
    assert found(dt.rank(awkward(spark), asked)) == expected(rows, items)
    assert found(dt.rank(awkward(spark, empty=True), asked)) == []
    assert found(dt.rank(awkward(spark), asked.limit(0))) == []
    assert found(dt.rank(awkward(spark), asked.where("item_id IN (2, 3)"))) == []


def test_pairs_are_pruned():
    """Documents of one language never meet the items of another."""
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 200, 20) + 200 * (i % 2)) for i in range(16)]
    weights = np.full(400, 1000)
    [(used, tree)] = dt.item_forest(sets, weights)
    rows, columns = [], []
    for d in range(512):
        mine = np.unique(rng.integers(0, 200, 40) + 200 * (d % 2))
        place = np.searchsorted(used, mine)
        mine = place[(place < len(used)) & (used[np.minimum(place, len(used) - 1)] == mine)]
        rows += [d] * len(mine)
        columns += mine.tolist()
    block = dt.Block(tree, len(used), np.array(rows), np.array(columns), np.full(len(rows), 1000), list(range(512)))
    best, seen = dt.Best(np.full(16, 8_000), 5), []
    best.add = lambda item, scores, ids: seen.extend(ids)
    dt.descend(tree, block, best, 0, 0, np.zeros(1, np.int64))
    scores = np.zeros((16, 512), int)
    np.add.at(scores, (slice(None), np.array(rows)), 0)
    dense = np.zeros((512, len(used)), int)
    dense[rows, columns] = 1000
    want = sum(int((dense[:, np.searchsorted(used, s)].sum(axis=1) >= 8_000).sum()) for s in sets)
    assert len(seen) == want > 0
