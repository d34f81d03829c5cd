"""Distributed ranks against plain window functions on the same rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ordermill.operators import ranking, rfm, skew

SIZES = [1, 2, 3, 6, 13, 250]


def people(spark, n, seed=1):
    pick = random.Random(seed)
    rows = []
    for i in range(n):
        # A third of all rows shares one value; some values are missing.
        value = 7.5 if pick.random() < 0.34 else pick.choice([None, round(pick.random() * 50, 2), -3.0])
        rows.append((f"u{i:05d}", pick.choice([None, 1, 1, 1, 2, 90]), value))
    pick.shuffle(rows)
    return spark.createDataFrame(rows, "id string, days int, value double").repartition(5)


@pytest.mark.parametrize("n", SIZES)
def test_ntile_equals_global_window(spark, n):
    df = people(spark, n)
    keys = {"d": ranking.descending("days"), "v": ranking.ascending("value")}
    ours = ranking.ntile_scores(df, keys, "id")
    assert dict(ours.dtypes)["d"] == "int"
    expected = df.withColumns(
        {
            "d": F.ntile(5).over(Window.orderBy(F.desc("days"), "id")),
            "v": F.ntile(5).over(Window.orderBy(F.asc("value"), "id")),
        }
    )
    assert sorted(ours.select("id", "d", "v").collect()) == sorted(expected.select("id", "d", "v").collect())


@pytest.mark.parametrize("n", SIZES)
def test_percent_rank_score_equals_global_window(spark, n):
    df = people(spark, n, seed=2)
    keys = {"d": ranking.descending("days"), "v": ranking.ascending("value")}
    ours = ranking.percent_rank_scores(df, keys, "id")

    def score(order):
        rank = F.percent_rank().over(Window.orderBy(order))
        return F.least(F.lit(5), (F.floor(rank * 5) + 1).cast("int"))

    expected = df.withColumns({"d": score(F.desc("days")), "v": score(F.asc("value"))})
    assert sorted(ours.select("id", "d", "v").collect()) == sorted(expected.select("id", "d", "v").collect())


def test_positions_equal_row_number(spark):
    df = people(spark, 250)
    order = [F.desc("value"), F.asc("id")]
    ours = ranking.with_position(df, "place", order)
    expected = df.withColumn("place", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    assert sorted(map(str, ours.collect())) == sorted(map(str, expected.collect()))


def test_ranking_spreads_one_hot_value(spark):
    rows = spark.range(40_000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.rand(3)).alias("value")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    try:
        slices = ranking._sorted_slices(rows, [F.asc("value"), F.asc("id")])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", 2)
    sizes = [r["count"] for r in slices.groupBy("_slice").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 40_000 / 3


def test_empty_table_is_ranked(spark):
    df = people(spark, 3).limit(0)
    assert ranking.ntile_scores(df, {"v": ranking.ascending("value")}, "id").count() == 0
    assert ranking.with_position(df, "place", [F.asc("id")]).count() == 0


def profile(spark, rows):
    return spark.createDataFrame(
        rows, "customer_unique_id string, total_orders long, total_revenue double, recency_days int"
    )


def test_rfm_best_and_worst_customer(spark):
    rows = [(f"c{i}", i, i * 100.0, 120 - 20 * i) for i in range(1, 6)]
    seen = {r["customer_unique_id"]: r for r in rfm.rfm_segments(profile(spark, rows)).collect()}
    scores = ["recency_score", "frequency_score", "monetary_score"]
    assert [seen["c5"][s] for s in scores] == [5, 5, 5] and seen["c5"]["segment_label"] == "Champion"
    assert [seen["c1"][s] for s in scores] == [1, 1, 1] and seen["c1"]["segment_label"] == "Lost"


def test_rfm_by_rank_keeps_ties_together(spark):
    rows = [(f"c{i}", 1 if i < 8 else i - 6, 50.0, 10) for i in range(10)]
    seen = rfm.rfm_segments_by_rank(profile(spark, rows)).collect()
    assert {r["monetary_score"] for r in seen} == {1} and {r["recency_score"] for r in seen} == {1}
    assert sorted(r["frequency_score"] for r in seen) == [1] * 8 + [4, 5]
    assert {r["repeat_customer_flag"] for r in seen} == {0, 1}


def test_rfm_reports(spark):
    rows = [(f"c{i}", i, i * 100.0, 120 - 20 * i) for i in range(1, 6)]
    segments = rfm.rfm_segments(profile(spark, rows)).selectExpr(
        "*", "1.0D AS avg_order_value", "CAST(NULL AS DOUBLE) AS avg_review_score", "0.0D AS late_delivery_rate"
    )
    table = {r["segment_label"]: r for r in rfm.rfm_profiles(segments).collect()}
    assert table["Champion"]["repeat_customers"] == 1 and table["Lost"]["repeat_customer_rate"] == 0.0
    assert table["Lost"]["avg_review_score"] is None
    assert sum(r["customers"] for r in rfm.rfm_distribution(segments).collect()) == 5


def skewed(spark):
    """A third of the rows has one key, a third has no key."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id") % 500)
    return spark.range(30_000).select("id", key.cast("bigint").alias("k"))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_plain_join(spark, how):
    fact = skewed(spark)
    one = spark.range(300).selectExpr("id AS k", "id * 2 AS v")
    salted = skew.join_one(fact, one, "k", spread_on="id", how=how)
    plain = fact.join(one, "k", how)
    assert salted.columns == plain.columns
    assert salted.exceptAll(plain).isEmpty() and plain.exceptAll(salted).isEmpty()


def test_hot_key_is_found_and_spread(spark):
    fact = skewed(spark)
    found = spark.range(1).select(skew.hot_keys(fact, "k", partitions=64).alias("hot")).first()["hot"]
    assert 7 in found and len(found) <= 64 / skew.HOT_MEANS
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    try:
        one = spark.range(300).selectExpr("id AS k", "id AS v")
        joined = skew.join_one(fact, one, "k", spread_on="id")
        sizes = [r[1] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", 2)
    assert max(sizes) < 30_000 / 4


def test_unknown_join_type_is_refused(spark):
    with pytest.raises(ValueError):
        skew.join_one(spark.range(1), spark.range(1), "id", spread_on="id", how="full")


def test_whole_numbers_beyond_doubles_keep_their_order(spark):
    rows = [(i, (1 << 53) + i) for i in range(10)]
    df = spark.createDataFrame(rows, "id long, v long")
    found = ranking.ntile_scores(df.withColumn("id", -F.col("id")), {"s": ranking.ascending("v")}, "id", parts=10)
    assert {r["v"] - (1 << 53): r["s"] for r in found.collect()} == {i: i + 1 for i in range(10)}
