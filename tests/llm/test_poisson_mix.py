import hashlib
import math

import pytest

from tests.llm.brute import AWKWARD, awkward, documents
from tidegate.llm import poisson_mix as pm


def expected(rows, rates, seed=pm.SEED):
    """doc_id -> copies, by inverting the distribution at the hashed number."""
    out = {}
    for doc_id, source in rows:
        rate = rates[source]
        parts = max(1, math.ceil(rate / pm.RATE_PER_DRAW))
        total = 0
        for part in range(1, parts + 1):
            name = f"{seed}:{'null' if doc_id is None else doc_id}:{part}"
            u = int(hashlib.md5(name.encode()).hexdigest()[:13], 16) / 2**52
            k, p = 0, math.exp(-rate / parts)
            reached = p
            while reached <= u:
                k += 1
                p *= rate / parts / k
                reached += p
            total += k
        out[doc_id] = total
    return out


def copies(df):
    seen = {}
    for r in df.collect():
        seen.setdefault(r.doc_id, []).append(r.copy)
    return {k: sorted(v) for k, v in seen.items()}


def test_whole_table(spark):
    docs = documents(spark, "/root/testdata/sf0.1")
    rows = [(r.doc_id, r.source) for r in docs.select("doc_id", "source").collect()]
    rates = {r.source: r.rate for r in pm.source_rates(docs).collect()}
    assert sum(rates[s] for _, s in rows) == pytest.approx(len(rows))
    want = {d: list(range(n)) for d, n in expected(rows, rates).items() if n}
    mixed = pm.mix(docs)
    assert copies(mixed) == want
    sizes = {r["source"]: r["count"] for r in mixed.groupBy("source").count().collect()}
    for source, rate in rates.items():
        goal = rate * sum(s == source for _, s in rows)
        assert abs(sizes[source] - goal) < 5 * math.sqrt(goal)


def test_weights_and_draws(spark):
    docs = documents(spark)
    mixed = pm.mix(docs, weights={"src0": 1.0, "src1": 3.0, "src2": 0.0}, draws=4000)
    sizes = {r["source"]: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert sizes.keys() == {"src0", "src1"}
    assert abs(sizes["src0"] - 1000) < 160 and abs(sizes["src1"] - 3000) < 280


def test_order_is_random_and_repeatable(spark):
    docs = documents(spark)
    one, two = ([(r.doc_id, r.copy) for r in pm.mix(docs).collect()] for _ in range(2))
    assert one == two
    ids = [d for d, _ in one]
    rises = sum(a < b for a, b in zip(ids, ids[1:], strict=False)) / len(ids)
    assert 0.42 < rises < 0.58
    assert sorted(one) != sorted((r.doc_id, r.copy) for r in pm.mix(docs, seed=1).collect())


@pytest.mark.parametrize("sources", [0, pm.BROADCAST_SOURCES])
def test_awkward_rows(spark, sources):
    clash = awkward(spark).selectExpr("*", "5 AS copy", "6 AS Shuffle_Key", "7 AS rate", "8 AS n")
    mixed = pm.mix(clash, draws=6_000, broadcast_sources=sources)
    assert mixed.columns == [c for c in clash.columns if c.lower() not in ("copy", "shuffle_key")] + [
        "copy",
        "shuffle_key",
    ]
    rates = {r.source: r.rate for r in pm.source_rates(clash, draws=6_000).collect()}
    assert max(rates.values()) > pm.RATE_PER_DRAW and rates.keys() == {"a", "b", None}
    named = [r for r in AWKWARD if r[0] is not None]
    want = expected([(r[0], r[3]) for r in named], rates)
    rows = mixed.select("doc_id", "copy").collect()
    assert sum(r.doc_id is not None for r in rows) == sum(want[r[0]] for r in named)
    nameless = sorted(r.copy for r in rows if r.doc_id is None)
    assert nameless == list(range(len(nameless))) and abs(len(nameless) - rates["b"]) < 6 * math.sqrt(rates["b"])
    empty = awkward(spark, empty=True)
    assert pm.mix(empty).collect() == []
    assert pm.mix(clash, weights={}).collect() == []


def test_rows_without_id_have_counts_and_places_of_their_own(spark):
    """A third of the rows has no id: they neither come or go together nor lie in one task."""
    rows = spark.range(0, 9_000, 1, 4).selectExpr(
        "IF(id % 3 = 0, NULL, id) AS doc_id", "concat('text ', id) AS text", "IF(id % 3 = 0, NULL, 'a') AS source"
    )
    mixed = pm.mix(rows)
    assert [r.text for r in mixed.collect()] == [r.text for r in pm.mix(rows).collect()]
    lost = mixed.where("doc_id IS NULL")
    counts = lost.groupBy("text").count().select("count").distinct().count()
    assert counts > 2 and abs(lost.count() - 9_000 / (1 + math.sqrt(2))) < 400
    tasks = [sum(r.doc_id is None for r in part) for part in mixed.rdd.glom().collect()]
    assert max(tasks) < 2 * sum(tasks) / len(tasks)


def test_copies_of_a_row_lie_in_many_tasks(spark):
    rows = spark.range(0, 9_000, 1, 4).selectExpr("IF(id % 3 = 0, 7, id) AS doc_id", "'t' AS text", "'a' AS source")
    tasks = [sum(r.doc_id == 7 for r in part) for part in pm.mix(rows, draws=27_000).rdd.glom().collect()]
    assert sum(n > 0 for n in tasks) > len(tasks) // 2
