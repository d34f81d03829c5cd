from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ordermill.operators import audit, checks


@pytest.mark.parametrize("seed", range(3))
def test_exact_duplicates_equal_counting_whole_rows(spark, seed):
    chooser = random.Random(seed)
    values = [None, "", "a", "b"]
    rows = [(chooser.choice(values), chooser.choice(values), chooser.choice([None, 0.0, -0.0, 1.5, float("nan")])) for _ in range(80)]
    df = spark.createDataFrame(rows, "`x.y` string, b string, c double")
    plain = df.groupBy("`x.y`", "b", "c").count().agg(F.sum(F.col("count") - 1)).first()[0]
    assert audit.exact_duplicates(df).first()[0] == plain > 0


def test_no_duplicates_and_no_rows(spark):
    assert audit.exact_duplicates(spark.range(50)).first()[0] == 0
    assert audit.exact_duplicates(spark.range(0)).first()[0] == 0


def test_rows_of_one_hash_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(audit.F, "xxhash64", lambda *cells: F.lit(7))
    df = spark.createDataFrame([(1, "a"), (2, "a"), (2, "a"), (3, None)], "a int, b string")
    assert audit.exact_duplicates(df).first()[0] == 1


def plain_differences(actual, expected, keys, values, tolerance):
    right = expected.select(*keys, *[F.col(v).alias(f"expected_{v}") for v in values])
    wrong = F.lit(False)
    for v in values:
        wrong = wrong | F.col(v).isNull() | F.col(f"expected_{v}").isNull() | (F.abs(F.col(v) - F.col(f"expected_{v}")) > tolerance)
    return actual.join(right, keys, "full").where(wrong)


def test_differences_equal_the_full_join(spark):
    chooser = random.Random(1)
    rows = [(f"k{i % 40}", i // 40, float(i), i) for i in range(400)]
    changed = [(a, b, c + chooser.choice([0, 0, 0, 0, 1e-9, 0.5]), d if chooser.random() > 0.05 else None) for a, b, c, d in rows if chooser.random() > 0.02]
    schema = "k string, m int, x double, y bigint"
    actual, expected = spark.createDataFrame(rows, schema), spark.createDataFrame(changed + [("new", 1, 1.0, 1), (None, 2, 1.0, 1)], schema)
    keys, values = ["k", "m"], ["x", "y"]
    found = sorted(map(repr, checks.differences(actual, expected, keys, values, 1e-6).collect()))
    assert found == sorted(map(repr, plain_differences(actual, expected, keys, values, 1e-6).collect())) and found
    assert checks.suspect_keys(actual, actual.withColumn("y", F.col("y").cast("double")), keys, values).isEmpty()
    assert checks.differences(expected, expected, keys, values).count() == expected.where("y is null").count() + 2  # a null key meets nothing


def test_a_missing_value_on_both_sides_is_a_difference(spark):
    df = spark.createDataFrame([("a", None), ("b", 1.0)], "k string, x double")
    assert [r["k"] for r in checks.differences(df, df, ["k"], ["x"]).collect()] == ["a"]
