"""Key and null checks on small frames with known errors."""

import json

import pytest

from tidegate.operators.validation import NULLS, PRIMARY_KEY, validate

SCHEMA = "product_id INT, item STRING, quantity INT"


def goods(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def level(frame):
    return [tuple(row)[:-1] for row in frame.collect()]


def test_both_checks_in_the_order_asked_for(spark):
    df = goods(spark, [(1, "a", 1), (1, None, None), (2, None, 3), (None, "x", 1), (None, "y", 1)])
    suite = validate(df, [NULLS, PRIMARY_KEY], ["product_id"], ["item", "quantity"])
    assert level(suite.dataset_level) == [(NULLS, False, 5, 2), (PRIMARY_KEY, False, 5, 4)]
    assert suite.passed() == {NULLS: False, PRIMARY_KEY: False}
    keys = suite.results[PRIMARY_KEY].record_level
    assert keys.columns == [
        "validation_type",
        "observed_record_pk",
        "expected_count",
        "observed_count",
        "ts",
    ]
    assert sorted(level(keys)) == [
        (PRIMARY_KEY, '{"product_id":1}', 0, 2),
        (PRIMARY_KEY, "{}", 0, 2),
    ]
    assert sorted(level(suite.results[NULLS].record_level)) == [
        (NULLS, '{"product_id":1}', 0, 1),
        (NULLS, '{"product_id":2}', 0, 1),
    ]


def test_clean_data_passes_and_lists_nothing(spark):
    df = goods(spark, [(1, "a", 1), (2, "b", 1)])
    suite = validate(df, [PRIMARY_KEY, NULLS], ["product_id"], ["item"])
    assert level(suite.dataset_level) == [(PRIMARY_KEY, True, 2, 0), (NULLS, True, 2, 0)]
    for result in suite.results.values():
        assert result.passed()
        assert result.record_level.count() == 0


def test_empty_dataset_passes(spark):
    suite = validate(goods(spark, []), [PRIMARY_KEY, NULLS], ["product_id"], ["item"])
    assert level(suite.dataset_level) == [(PRIMARY_KEY, True, 0, 0), (NULLS, True, 0, 0)]


def test_one_check_alone_agrees_with_the_suite(spark):
    df = goods(spark, [(1, "a", 1), (1, None, 1), (3, None, 1)])
    suite = validate(df, [PRIMARY_KEY, NULLS], ["product_id"], ["item"])
    together = {row.validation_type: row for row in suite.dataset_level.collect()}
    for kind, result in suite.results.items():
        assert result.dataset_level.first() == together[kind]


def test_hot_key_is_counted_before_the_shuffle(spark):
    df = spark.range(0, 30000, 1, 8).selectExpr("IF(id % 3 = 0, 0, id) AS k", "id")
    suite = validate(df, [PRIMARY_KEY], ["k"])
    plan = suite.dataset_level._jdf.queryExecution().executedPlan().toString()
    assert "partial_count(1)" in plan
    assert plan.count("hashpartitioning") == 1
    assert level(suite.dataset_level) == [(PRIMARY_KEY, False, 30000, 10000)]


def test_awkward_column_names(spark):
    df = spark.createDataFrame([(1, None), (1, 2)], "`a.b` INT, `c d``e` INT")
    suite = validate(df, [PRIMARY_KEY, NULLS], ["a.b"], ["c d`e"])
    assert level(suite.dataset_level) == [(PRIMARY_KEY, False, 2, 2), (NULLS, False, 2, 1)]
    pk = suite.results[NULLS].record_level.first().observed_record_pk
    assert json.loads(pk) == {"a.b": 1}


@pytest.mark.parametrize(
    ("kinds", "keys", "required"),
    [
        (["typo"], ["product_id"], ["item"]),
        ([PRIMARY_KEY], [], None),
        ([PRIMARY_KEY], None, None),
        ([NULLS], ["product_id"], []),
        ([NULLS], None, ["item"]),
        ([], ["product_id"], ["item"]),
    ],
)
def test_bad_arguments_are_refused(spark, kinds, keys, required):
    with pytest.raises(ValueError):
        validate(goods(spark, []), kinds, keys, required)
