from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from ordermill.operators import backtest, checks

ROW = (
    "category_name_english string, forecast_month string, target_units double, lag_1 double, lag_2 double,"
    " lag_4 double, rolling_mean_3 double, month_num int, is_q4 int, is_comparable_period boolean"
)


def features(spark, last_is_comparable=True):
    rows = []
    for m in range(1, 7):
        for c, units in (("a", 10.0 * m), ("b", 5.0 * m)):
            good = last_is_comparable or m < 6
            rows.append((c, f"2024-{m:02d}", units, units - 1, 1.0, 1.0, units - 2, m, 0, good))
    return spark.createDataFrame(rows, ROW)


def metrics(spark, pairs):
    df = spark.createDataFrame(pairs, "target_units double, prediction double")
    return df.agg(*backtest.regression_metrics()).first().asDict()


def test_percentage_errors_survive_zeros(spark):
    assert metrics(spark, [(0.0, 2.0), (10.0, 5.0)])["mape"] == 125.0
    assert metrics(spark, [(0.0, 0.0), (10.0, 5.0)])["mape"] == 25.0
    zero = metrics(spark, [(0.0, 0.25), (0.0, 0.25)])
    assert zero["wape"] == 50.0 and zero["r2"] == 0.0 and zero["smape"] == 200.0
    constant = metrics(spark, [(4.0, 3.0), (4.0, 5.0)])
    assert constant["r2"] == 0.0 and constant["mae"] == constant["rmse"] == 1.0
    usual = metrics(spark, [(1.0, 2.0), (3.0, 3.0), (5.0, 2.0)])
    assert usual["r2"] == pytest.approx(1 - 10 / 8) and usual["wape"] == pytest.approx(400 / 9)
    assert usual["rmse"] == pytest.approx(math.sqrt(10 / 3))


def test_chronological_split(spark):
    split = backtest.chronological_split(features(spark), 2)
    months = {r[0] for r in split.where("is_validation").select("forecast_month").collect()}
    assert months == {"2024-05", "2024-06"} and split.count() == 12
    with pytest.raises(ValueError):
        backtest.chronological_split(features(spark), 6)
    with pytest.raises(ValueError):
        backtest.chronological_split(features(spark), 0)


def test_validation_months_are_comparable(spark):
    months = backtest.validation_months(features(spark, last_is_comparable=False), most=4)
    assert sorted(r[0] for r in months.collect()) == ["2024-02", "2024-03", "2024-04", "2024-05"]


def test_folds_train_on_earlier_months_only(spark):
    rows = backtest.naive_backtest(features(spark), most=2).collect()
    assert {r["forecast_month"] for r in rows} == {"2024-05", "2024-06"} and len(rows) == 4
    for r in rows:
        assert r["naive_prediction"] == r["lag_1"]
        assert r["max_train_forecast_month"] < r["forecast_month"]
    assert {(r["fold"], r["train_rows"]) for r in rows} == {(1, 8), (2, 10)}


def test_folds_without_training_rows_are_refused(spark):
    with pytest.raises(ValueError, match="no training rows"):
        backtest.require_folds(backtest.backtest_folds(features(spark)))
    single = features(spark).where("forecast_month = '2024-01'")
    with pytest.raises(ValueError, match="not enough"):
        backtest.require_folds(backtest.backtest_folds(single))


def test_boosted_backtest_predicts_every_fold(spark):
    rows = backtest.boosted_backtest(features(spark), most=2, params={"maxIter": 3}).collect()
    assert len(rows) == 4 and all(r["boosted_prediction"] >= 0 for r in rows)
    assert {r["fold"] for r in rows} == {1, 2}


def test_input_joins_the_coverage_of_the_target_month(spark):
    base = spark.createDataFrame(
        [("books", "2018-06", "2018-05", 3, 2, 1, 1, 1.5, 6, 0), ("books", "2018-07", "2018-06", 3, 2, 1, 1, 1.5, 7, 0)],
        "category_name_english string, forecast_month string, feature_cutoff_month string, target_units long,"
        " lag_1 long, lag_2 long, lag_4 long, rolling_mean_3 double, month_num int, is_q4 int",
    )
    coverage = spark.createDataFrame(
        [("2018-06", 200, False, False, True)],
        "order_year_month string, order_count long, is_partial_period boolean,"
        " is_low_volume_period boolean, is_comparable_period boolean",
    )
    rows = {r["forecast_month"]: r for r in backtest.backtest_input(base, coverage).collect()}
    assert (rows["2018-06"]["target_period_order_count"], rows["2018-06"]["is_comparable_period"]) == (200, True)
    assert (rows["2018-07"]["target_period_order_count"], rows["2018-07"]["is_comparable_period"]) == (0, False)
    with pytest.raises(ValueError, match="lag_4"):
        backtest.backtest_input(base.drop("lag_4"), coverage)


def test_preparing_drops_unreadable_numbers(spark):
    raw = spark.createDataFrame(
        [("a", "2018-06-01", "3", "x"), ("a", "2018-07", "4", "5")],
        "category_name_english string, forecast_month string, target_units string, lag_1 string",
    ).selectExpr("*", "'1' AS lag_2", "'1' AS lag_4", "'1' AS rolling_mean_3", "'7' AS month_num", "'0' AS is_q4")
    prepared = backtest.prepare_backtest_input(raw).collect()
    assert len(prepared) == 1
    row = prepared[0]
    assert (row["forecast_month"], row["feature_cutoff_month"], row["lag_1"]) == ("2018-07", "2018-06", 5.0)
    assert row["is_comparable_period"] and row["target_period_order_count"] is None


@pytest.fixture
def predictions(spark):
    return spark.createDataFrame(
        [("a", "2018-06", 10.0, 9.0), ("b", "2018-06", 5.0, 4.0), ("a", "2018-07", 8.0, 7.0)],
        "category_name_english string, forecast_month string, target_units double, naive_prediction double",
    ).withColumns(
        {
            "champion_prediction": F.col("naive_prediction"), "lag_1": F.col("naive_prediction"),
            "lag_2": F.lit(1.0), "lag_4": F.lit(1.0), "rolling_mean_3": F.lit(1.0), "fold": F.lit(1),
            "train_rows": F.lit(5), "feature_cutoff_month": F.lit("2018-05"),
            "max_train_forecast_month": F.lit("2018-05"),
        }
    )


def test_monthly_and_category_tables(predictions):
    june = backtest.backtest_monthly(predictions).first()
    assert (june["forecast_month_label"], june["actual_units"], june["champion_prediction"]) == ("Jun 2018", 15.0, 13.0)
    assert (june["evaluated_rows"], june["category_count"], june["champion_abs_error"]) == (2, 2, 2.0)
    worst = backtest.backtest_category_errors(predictions).first()
    assert (worst["category_name_english"], worst["actual_units"], worst["absolute_error"]) == ("a", 18.0, 2.0)
    assert worst["forecast_month_count"] == 2 and worst["mae"] == 1.0
    assert backtest.top_category_errors(backtest.backtest_category_errors(predictions), 1).count() == 1


def test_boosted_forecasts_do_not_depend_on_partitions(spark, folder):
    rows = features(spark)
    few = backtest.boosted_backtest(rows.coalesce(1), most=2, params={"maxIter": 4})
    many = backtest.boosted_backtest(rows.repartition(5), most=2, params={"maxIter": 4}, model_path=f"{folder}/models")
    key = ["category_name_english", "forecast_month", "boosted_prediction"]
    assert sorted(map(tuple, few.select(*key).collect())) == sorted(map(tuple, many.select(*key).collect()))
    compared = backtest.with_champion(many)
    best = backtest.champion(backtest.pooled_metrics(many)).first()["champion_model"]
    for r in compared.collect():
        assert r["champion_prediction"] == r[backtest.PREDICTIONS[best]]
    listed = {r["model"]: r for r in backtest.model_metrics(compared).collect()}
    assert set(listed) == {"naive_lag_1", "boosted_trees"} and listed[best]["is_champion"]
    assert {r["evaluated_rows"] for r in listed.values()} == {4}


def test_too_few_months_give_no_predictions(spark):
    one = features(spark).where("forecast_month = '2024-01'")
    assert not backtest.can_be_tested(one) and backtest.can_be_tested(features(spark), most=2)
    empty = backtest.with_champion(backtest.no_predictions(one))
    assert empty.count() == 0 and backtest.backtest_monthly(empty).count() == 0


@pytest.mark.parametrize(
    "challenger, expected",
    [((1.0, 1.0, 9.0), "boosted_trees"), ((1.0, 3.0, 1.0), "naive_lag_1"), ((3.0, 1.0, 1.0), "naive_lag_1"), ((2.0, 2.0, 2.0), "naive_lag_1")],
)
def test_champion_needs_lower_mae_and_rank(spark, challenger, expected):
    pooled = spark.createDataFrame(
        [("naive_lag_1", 2.0, 2.0, 2.0), ("boosted_trees", *challenger)],
        "model string, wape double, mae double, rmse double",
    )
    assert backtest.champion(pooled).first()["champion_model"] == expected


def audited(spark, predictions, **changed):
    stored = dict(
        monthly=backtest.backtest_monthly(predictions),
        category_errors=backtest.backtest_category_errors(predictions),
        fold_metrics=backtest.fold_metrics(predictions),
        inputs=spark.range(1).selectExpr(
            "1 AS target_period_order_count", "true AS is_partial_period",
            "true AS is_low_volume_period", "true AS is_comparable_period",
        ),
    )
    stored.update(changed)
    rows = checks.backtest_audit(predictions, **stored)
    rows = spark.createDataFrame(rows.collect(), rows.schema).coalesce(1)
    return {r["check_name"] for r in rows.where("not passed").collect()}, checks.verdict(rows).first()


def test_audit_passes_consistent_results(spark, predictions):
    failed, verdict = audited(spark, predictions)
    assert not failed and verdict["verdict"] == "PASS"


def test_audit_finds_changed_results(spark, predictions):
    monthly = backtest.backtest_monthly(predictions).withColumn("actual_units", F.col("actual_units") + 1e-3)
    failed, verdict = audited(spark, predictions, monthly=monthly)
    assert failed == {"monthly_totals_match_predictions"} and verdict["verdict"] == "FAIL"
    labels = backtest.backtest_monthly(predictions).withColumn("forecast_month_label", F.lit("2018-06"))
    assert "monthly_labels_are_month_names" in audited(spark, predictions, monthly=labels)[0]
    leaking = predictions.withColumn("max_train_forecast_month", F.lit("2018-07"))
    assert "no_train_row_reaches_validation_month" in audited(spark, leaking)[0]
    shifted = predictions.withColumn("lag_1", F.col("lag_1") + 1)
    assert audited(spark, shifted)[0] == {"naive_equals_lag_1"}
    assert audited(spark, predictions, inputs=spark.range(1))[0] == {"target_period_comparability_flags"}
