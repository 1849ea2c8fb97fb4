import zlib

import numpy as np

from tests.llm.brute import awkward, documents
from tidegate.llm import compress_quality as cq


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = cq.classify(docs, labels).join(labels, "doc_id", "left").toPandas()
    assert len(rows) == docs.count() and rows["score"].between(0, 1).all()
    assert (rows["predicted"] == (rows["score"] >= 0.3)).all()
    held = np.array([zlib.crc32(str(i).encode()) % 5 == 0 for i in rows["doc_id"]])
    assert (rows["held_out"] == held).all()
    known = rows[held & rows["quality"].notna()]
    good, bad = known[known["quality"] == 1], known[known["quality"] == 0]
    assert (good["predicted"] == 1).mean() > 0.98
    assert (bad["predicted"] == 0).mean() > 0.75
    above = good["score"].to_numpy()[:, None] > bad["score"].to_numpy()
    assert above.mean() > 0.98
    calibrated = known["score"].mean() - known["quality"].mean()
    assert abs(calibrated) < 0.03


def test_answers_do_not_depend_on_the_held_out_labels(spark):
    docs = documents(spark)
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    turned = labels.selectExpr(
        "doc_id", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality"
    )
    one, two = (
        {r.doc_id: r.score for r in cq.classify(docs, x).collect()} for x in (labels, turned)
    )
    assert one == two


def test_awkward_rows(spark):
    labels = spark.createDataFrame(
        [(1, 1), (1, 0), (2, 1), (None, 1), (4, None), (9, 1), (6, 0)], "doc_id bigint, quality int"
    )
    for known in (labels, labels.where("quality = 1"), labels.limit(0)):
        rows = cq.classify(awkward(spark), known).collect()
        assert len(rows) == 11 and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
        assert len({r.score for r in rows if r.doc_id in (2, 3)}) == 1
        assert cq.classify(awkward(spark, empty=True), known).collect() == []
    assert {r.score for r in cq.classify(awkward(spark), labels.limit(0)).collect()} == {0.5}


def test_all_of_a_long_text_counts_wherever_it_stands(spark):
    rng = np.random.default_rng(4)
    good, bad = ([f"{c}{rng.integers(10**9)}" for _ in range(3_000)] for c in "gb")

    def text(vocabulary, n):
        return " ".join(rng.choice(vocabulary, n // 10))[:n]

    texts = [text(good, 4_000), text(good, 1_000_000)]
    halves = text(good, 500_000), text(bad, 500_000)
    texts += [halves[0] + halves[1], halves[1] + halves[0]]
    dictionaries = [" ".join(v).encode() for v in (good, bad)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    by_length = {r.doc_id: r.by_length for r in cq.measure(docs, *dictionaries).collect()}
    assert by_length[0] > 0.05 and abs(by_length[1] / by_length[0] - 1) < 0.1
    assert abs(by_length[2] - by_length[3]) < 0.01 * by_length[0]


def test_logistic_finds_the_weights():
    rng = np.random.default_rng(3)
    x = rng.normal(5, 3, (20_000, 2))
    y = (rng.random(20_000) < 1 / (1 + np.exp(-(1 + x @ [0.7, -0.4])))).astype(float)
    assert np.allclose(cq.logistic(x, y), [1, 0.7, -0.4], atol=0.15)
    separable = cq.logistic(x, (x[:, 0] > 5).astype(float))
    assert np.isfinite(separable).all() and separable[1] > 0
