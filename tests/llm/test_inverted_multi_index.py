import math
import random

import numpy as np
import pytest

from tests.compare import spark_bag, sql_bag
from tests.llm.brute import SF_DIR
from tidegate.llm import inverted_multi_index as im
from tidegate.llm import queries


def expected(rows, every=50, positives=5, negatives=3):
    fit = {}
    for vec_id, label, v in rows:
        if vec_id is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        now = (label, [math.floor(256 * x) for x in v])
        fit[vec_id] = min(now, fit.get(vec_id, now))
    out = []
    for a, (label, q) in fit.items():
        if a % every:
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(q, v)), i, other == label) for i, (other, v) in fit.items() if i != a
        )
        for ps, p, _ in [r for r in scored if r[2]][:positives]:
            inside = [(i, -s) for s, i, same in scored if not same and 50 * -ps <= 100 * -s <= 95 * -ps]
            out += [(a, p, n, i, -ps, s) for n, (i, s) in enumerate(inside[:negatives], 1)]
    return sorted(out)


def found(df):
    return sorted(map(tuple, df.collect()))


SCHEMA = "vec_id bigint, label int, embedding array<float>"
ANCHOR = "vec_id % 50 = 0"


def test_query_equals_sql(spark):
    name = "op13_inverted_multi_index"
    assert spark_bag(queries.QUERIES[name](spark, SF_DIR)) == sql_bag(SF_DIR, queries.ORACLES[name])


@pytest.mark.parametrize("cell, rows", [(4, 64), (64, 4096)])
def test_any_size_of_cells(spark, monkeypatch, cell, rows):
    monkeypatch.setattr(im, "ROWS", rows)
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    want = expected([(r.vec_id, r.label, r.embedding) for r in table.collect()])
    assert found(im.mine(table, ANCHOR, cell=cell)) == want


def test_batches_of_anchors(spark, monkeypatch):
    monkeypatch.setattr(im, "COMPONENTS", 64 * 3)
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    assert found(im.mine(table, ANCHOR)) == expected([(r.vec_id, r.label, r.embedding) for r in table.collect()])


def test_copies_ties_and_a_crowded_cell(spark, monkeypatch):
    monkeypatch.setattr(im, "ROWS", 32)
    rng = random.Random(4)
    centre = [rng.uniform(0, 1) for _ in range(6)]
    rows = [(i, i % 3, centre) for i in range(200)]
    rows += [(i, i % 2, [c * rng.choice([0.6, 0.8, 1.0]) for c in centre]) for i in range(200, 420)]
    df = spark.createDataFrame(rows, SCHEMA)
    rows = [(r.vec_id, r.label, r.embedding) for r in df.collect()]
    assert found(im.mine(df.repartition(5), ANCHOR, cell=8)) == expected(rows)


def test_awkward_rows(spark):
    rng = random.Random(2)
    rows = [(i, i % 2, [rng.uniform(-1, 1) for _ in range(rng.choice([0, 3, 4]))]) for i in range(120)]
    rows += [
        (None, 1, [1.0]), (130, None, [1.0]), (131, 1, None), (132, 1, [float("nan"), 1.0]),
        (133, 1, [float("inf")]), (134, 0, [1.0, None]), (50, 0, [9.0, 9.0]), (7, 1, [0.5]), (7, 1, [0.5]),
        (150, 1, []), (200, 5, [1.0, 1.0]),
    ]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS v", "2 AS i", "'z' AS LABEL")
    rows = [(r[0], r[1], r[2]) for r in df.collect()]
    assert found(im.mine(df, ANCHOR)) == expected(rows)
    assert found(im.mine(df.limit(0), ANCHOR)) == []
    assert found(im.mine(df, "vec_id < 0")) == []
    assert found(im.mine(df.where("vec_id = 0"), ANCHOR)) == []


def test_components_beyond_exact_scores_are_refused(spark):
    df = spark.createDataFrame([(0, 1, [1e9, 1.0]), (1, 1, [1.0, 1.0])], SCHEMA)
    with pytest.raises(ValueError, match="too large"):
        im.mine(df, ANCHOR)


def test_a_visit_leaves_out_cells_below_the_floor():
    """Two far groups: the one that cannot reach the floor is never visited."""
    import pyarrow as pa

    rng = np.random.default_rng(3)
    points = np.concatenate([rng.integers(90, 110, (50, 8)), rng.integers(-110, -90, (50, 8))]).astype(float)
    words = [np.array([[100.0] * 4, [-100.0] * 4])] * 2
    radii = [np.full(2, 40.0)] * 2
    code = (points[:, 0] < 0).astype(np.int32)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(code), pa.array(code), pa.array(np.arange(100)), pa.array(np.zeros(100, int)),
         pa.array(points.astype(int).tolist(), pa.list_(pa.int64()))],
        names=["i", "j", "vec_id", "label", "v"],
    )
    index = im.Index(None, words, radii, 8)
    cells = im.Cells(batch, index)
    first, second = cells.bounds(points[:1], index)
    seen = [i for rows in cells.visit(first[0], second[0], lambda: 0.0) for i in cells.ids[rows].tolist()]
    assert sorted(seen) == list(range(50))
    scores = points @ points[0]
    order = [first[0][a] + second[0][a] for a in (0, 1)]
    assert order[0] >= scores[:50].max() and order[1] >= scores[50:].max()
