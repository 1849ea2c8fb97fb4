"""The key check for nearly unique keys."""

import random

import numpy as np
import pytest

from tests.test_validation import goods, level
from tidegate.operators import unique_keys
from tidegate.operators.unique_keys import candidates, packed, unpacked
from tidegate.operators.validation import NULLS, PRIMARY_KEY, validate


def both_ways(df, kinds, keys, required=None):
    """The frames of the usual check and of the one for nearly unique keys."""
    suites = [validate(df, kinds, keys, required, expect_unique=e) for e in (False, True)]
    return [
        [sorted(level(f), key=str) for f in (s.dataset_level, *(r.record_level for r in s.results.values()))]
        for s in suites
    ]


@pytest.mark.parametrize("rows", [0, 2, 5_000])
def test_same_rows_as_the_usual_check(spark, rows):
    rng = random.Random(rows)
    data = [(rng.choice([None, n, n, n, n, n // 2]), rng.choice(["a", None]), n) for n in range(rows)]
    usual, unique = both_ways(goods(spark, data).repartition(3), [NULLS, PRIMARY_KEY], ["product_id"], ["item"])
    assert unique == usual


def test_a_third_of_the_rows_with_one_key(spark):
    df = spark.range(0, 30000, 1, 8).selectExpr("IF(id % 3 = 0, 0, id) AS `a.b`", "CAST(id % 2 AS STRING) AS s")
    usual, unique = both_ways(df, [PRIMARY_KEY], ["a.b"])
    assert unique == usual and unique[0] == [(PRIMARY_KEY, False, 30000, 10000)]


def test_null_members_and_signed_zeros_are_equal_keys(spark):
    data = [(None, 0.0), (None, -0.0), (1, float("nan")), (1, float("nan")), (1, None), (None, None)]
    df = spark.createDataFrame(data, "a INT, b DOUBLE")
    usual, unique = both_ways(df, [PRIMARY_KEY], ["a", "b"])
    assert unique == usual and unique[0][0][3] == 4


@pytest.mark.parametrize("bits, rows, ranges", [(6, 12, 22), (8, 60, 3), (16, 2_000, 10)])
def test_slices_and_ranges_of_bits(spark, monkeypatch, bits, rows, ranges):
    """Few bits take several slices; each has as many ranges as it needs."""
    monkeypatch.setattr(unique_keys, "RANGE_BITS", ranges)
    df = spark.range(0, rows, 1, 4).selectExpr("IF(id < 20, id DIV 2, id) AS id")
    found = candidates(df, ["id"], most_bits=bits)
    repeated = {r.id for r in df.groupBy("id").count().where("count > 1").collect()}
    kept = [r.id for r in found.rows.collect()]
    assert found.total == rows
    assert sorted(r for r in kept if r in repeated) == sorted([*repeated] * 2)


def test_unique_keys_shuffle_under_a_fifth(spark):
    """Bytes written to the shuffle, against counting all rows by key."""
    df = spark.range(0, 2_000_000, 1, 8).selectExpr("xxhash64(id) AS k")
    tracker, said = spark.sparkContext._jsc.sc().statusStore(), {}
    for name, expect in (("usual", False), ("unique", True)):
        before = {s.stageId() for s in stages(tracker)}
        suite = validate(df, [PRIMARY_KEY], ["k"], expect_unique=expect)
        assert suite.passed() == {PRIMARY_KEY: True}
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        said[name] = sum(s.shuffleWriteBytes() for s in stages(tracker) if s.stageId() not in before)
    assert said["unique"] < said["usual"] / 5, said


def stages(store):
    found = store.stageList(None, False, False, getattr(store, "stageList$default$4")(), None)
    return [found.apply(i) for i in range(found.size())]


@pytest.mark.parametrize("inner", [4, 22])
def test_packing_gives_back_the_buckets(inner):
    rng = np.random.default_rng(inner)
    buckets = rng.integers(0, 1 << 24, 5_000)
    batch = packed(buckets.copy(), inner)
    got = np.concatenate(
        [unpacked(p) + (r << inner) for r, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
    )
    assert np.array_equal(got, np.sort(buckets))
