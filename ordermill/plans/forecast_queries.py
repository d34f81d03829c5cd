"""Registered queries of the forecast backtest."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.operators import backtest, checks
from ordermill.plans.presentation import means, show
from ordermill.plans.shop import Shop, sql
from ordermill.sources import readers, writers
from ordermill.sources.scratch import materialize, scratch_path

_METRICS = "mae rmse wape smape mape r2"
_MONTHLY_COLUMNS = (
    "forecast_month, forecast_month_label, actual_units, evaluated_rows, category_count,"
    f" {means('naive_prediction', 'moving_average_prediction', 'champion_prediction', 'champion_abs_error')}"
)
_CATEGORY_SQL = """SELECT category_name_english, sum(target_units) AS actual_units, sum(naive_prediction) AS naive_prediction,
    round(sum(moving_average_prediction), 6) AS moving_average_prediction, round(sum(champion_prediction), 6) AS champion_prediction,
    round(sum(abs(target_units - champion_prediction)), 6) AS absolute_error, count(*) AS evaluated_rows,
    count(DISTINCT forecast_month) AS forecast_month_count,
    round(sum(abs(target_units - champion_prediction)) / greatest(count(*), 1), 6) AS mae FROM bt_pred GROUP BY 1"""
_CATEGORY_ROUNDED = "moving_average_prediction champion_prediction absolute_error mae"

_METRIC_SQL = """round(avg(abs(target_units - prediction)), 6) AS mae,
    round(sqrt(avg(pow(target_units - prediction, 2))), 6) AS rmse,
    round(sum(abs(target_units - prediction)) / greatest(sum(abs(target_units)), 1.0) * 100, 6) AS wape,
    round(avg(2.0 * abs(target_units - prediction) / CASE WHEN abs(target_units) + abs(prediction) < 1e-12 THEN 1.0
        ELSE abs(target_units) + abs(prediction) END) * 100, 6) AS smape,
    round(avg(abs(target_units - prediction) / CASE WHEN abs(target_units) < 1e-12 THEN 1.0 ELSE abs(target_units) END) * 100, 6) AS mape,
    round(CASE WHEN var_pop(target_units) * count(*) > 1e-12
        THEN 1.0 - sum(pow(target_units - prediction, 2)) / (var_pop(target_units) * count(*)) ELSE 0.0 END, 6) AS r2"""


def _boosted(shop: Shop):
    """All but the value of the forecast, which no other engine's trees reproduce."""
    predictions = backtest.boosted_backtest(shop.stored_backtest_input)
    return predictions.select(
        "category_name_english", "forecast_month", "fold", "train_rows",
        "max_train_forecast_month", "target_units", "naive_prediction",
        F.coalesce(F.col("boosted_prediction") >= 0, F.lit(False)).alias("boosted_usable"),
    )


_NAMES = {"predictions": "predictions.csv", "monthly": "monthly.csv", "category_errors": "categories.json", "fold_metrics": "folds.json"}


def _stored_artifacts(shop: Shop) -> dict:
    """Results written as CSV and JSON reports and read back, as a later audit finds them."""
    predictions = materialize(shop.compared_predictions, "predictions")
    results = {
        "predictions": predictions,
        "monthly": backtest.backtest_monthly(predictions),
        "category_errors": backtest.backtest_category_errors(predictions),
        "fold_metrics": backtest.fold_metrics(predictions),
    }
    folder, stored = scratch_path(shop.spark, "reports"), {}
    for name, df in results.items():
        path = f"{folder}/{_NAMES[name]}"
        (writers.write_json_report if path.endswith(".json") else writers.write_csv_report)(df, path)
        schema = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in df.schema)
        stored[name] = readers.scan_report(shop.spark, path, schema)
    return stored


def _readable(stored: dict, name: str):
    """Whether no row of any report is unreadable."""
    bad = reduce(DataFrame.unionAll, [readers.corrupt_rows(df) for df in stored.values()])
    return bad.agg((F.sum("corrupt_rows") == 0).alias("passed")).select(
        F.lit(name).alias("artifacts"), F.lit("reports_are_readable").alias("check_name"), "passed"
    )


def _audit(shop: Shop):
    """The stored reports; the same with altered totals, errors, labels and cutoffs; the same with spoiled predictions."""
    stored = _stored_artifacts(shop)
    month = stored["monthly"].agg(F.min("forecast_month")).scalar()
    category = stored["category_errors"].agg(F.min("category_name_english")).scalar()
    altered = stored | {
        "monthly": stored["monthly"].withColumns({
            "actual_units": F.col("actual_units") + F.when(F.col("forecast_month") == month, 1.0).otherwise(0.0),
            "forecast_month_label": F.when(F.col("forecast_month") == month, F.col("forecast_month")).otherwise(
                F.col("forecast_month_label")
            ),
        }),
        "category_errors": stored["category_errors"].withColumn(
            "absolute_error",
            F.col("absolute_error") + F.when(F.col("category_name_english") == category, 1.0).otherwise(0.0),
        ),
        "fold_metrics": stored["fold_metrics"].withColumn("max_train_forecast_month", F.col("forecast_month")),
    }
    of_category = F.col("category_name_english") == category
    spoiled = stored | {
        "predictions": stored["predictions"].drop("lag_4").withColumns({
            "naive_prediction": F.col("naive_prediction") + F.when(of_category, 1.0).otherwise(0.0),
            "max_train_forecast_month": F.when(of_category, F.col("forecast_month")).otherwise(F.col("max_train_forecast_month")),
            "forecast_month": F.when(~of_category, F.col("forecast_month")),
        }),
    }

    def audited(artifacts: dict, name: str, inputs: DataFrame):
        found = checks.backtest_audit(**artifacts, inputs=inputs)
        return found.select(F.lit(name).alias("artifacts"), "check_name", "passed").unionAll(_readable(artifacts, name))

    inputs = shop.stored_backtest_input
    return (
        audited(stored, "stored", inputs)
        .unionAll(audited(altered, "altered", inputs))
        .unionAll(audited(spoiled, "spoiled", inputs.drop("is_partial_period")))
    )


_SPOILED_CATEGORY = "category_name_english = (SELECT min(category_name_english) FROM bt_pred)"
# The audited tables of every case: predictions, monthly totals, category errors, folds, inputs.
_AUDITED = {
    "stored": ("bt_pred", "stored_months", "stored_categories", "bt_folds", "bt_input"),
    "altered": ("bt_pred", "altered_months", "altered_categories", "altered_folds", "bt_input"),
    "spoiled": ("spoiled_pred", "stored_months", "stored_categories", "bt_folds", "spoiled_input"),
}
_TOTALS = "actual_units naive_prediction moving_average_prediction champion_prediction".split()


def _months_of(predictions: str) -> str:
    return f"""SELECT forecast_month, strftime(CAST(forecast_month || '-01' AS DATE), '%b %Y') AS forecast_month_label,
    sum(target_units) AS actual_units, sum(naive_prediction) AS naive_prediction, sum(moving_average_prediction) AS moving_average_prediction,
    sum(champion_prediction) AS champion_prediction, abs(sum(target_units) - sum(champion_prediction)) AS champion_abs_error,
    count(*) AS evaluated_rows, count(DISTINCT category_name_english) AS category_count FROM {predictions} GROUP BY forecast_month"""


def _categories_of(predictions: str) -> str:
    return f"""SELECT category_name_english, sum(target_units) AS actual_units, sum(naive_prediction) AS naive_prediction,
    sum(moving_average_prediction) AS moving_average_prediction, sum(champion_prediction) AS champion_prediction,
    sum(abs(target_units - champion_prediction)) AS absolute_error, sum(abs(target_units - champion_prediction)) / count(*) AS mae,
    count(*) AS evaluated_rows, count(DISTINCT forecast_month) AS forecast_month_count FROM {predictions} GROUP BY category_name_english"""


_AUDIT_TABLES = {
    "stored_months": ("bt_pred", _months_of("bt_pred")),
    "stored_categories": ("bt_pred", _categories_of("bt_pred")),
    "altered_months": (
        "stored_months",
        "SELECT * REPLACE (CASE WHEN first THEN actual_units + 1 ELSE actual_units END AS actual_units,"
        " CASE WHEN first THEN forecast_month ELSE forecast_month_label END AS forecast_month_label) FROM"
        " (SELECT *, forecast_month = min(forecast_month) OVER () AS first FROM stored_months)",
    ),
    "altered_categories": (
        "stored_categories bt_pred",
        f"SELECT * REPLACE (CASE WHEN {_SPOILED_CATEGORY} THEN absolute_error + 1 ELSE absolute_error END AS absolute_error) FROM stored_categories",
    ),
    "altered_folds": ("bt_folds", "SELECT * REPLACE (forecast_month AS max_train_forecast_month) FROM bt_folds"),
    "spoiled_pred": (
        "bt_pred",
        f"""SELECT * EXCLUDE (lag_4) REPLACE (CASE WHEN {_SPOILED_CATEGORY} THEN naive_prediction + 1 ELSE naive_prediction END AS naive_prediction,
        CASE WHEN {_SPOILED_CATEGORY} THEN forecast_month ELSE max_train_forecast_month END AS max_train_forecast_month,
        CASE WHEN {_SPOILED_CATEGORY} THEN NULL ELSE forecast_month END AS forecast_month) FROM bt_pred""",
    ),
    "spoiled_input": ("bt_input", "SELECT * EXCLUDE (is_partial_period) FROM bt_input"),
}


def _has_columns(table: str, columns: list[str]) -> str:
    return f"(SELECT list_has_all(json_keys(to_json(t)), {columns}) FROM {table} t LIMIT 1)"


def _same_as(stored: str, again: str, key: str, numbers: list[str], exact: list[str]) -> str:
    rules = [f"abs(s.{name} - r.{name}) <= 1e-7" for name in numbers] + [f"s.{name} = r.{name}" for name in exact]
    return f"(SELECT count(*) = 0 FROM {stored} s FULL JOIN ({again}) r ON s.{key} = r.{key} WHERE NOT coalesce({' AND '.join(rules)}, false))"


def _audit_rules(predictions: str, months: str, categories: str, folds: str, inputs: str) -> dict[str, str]:
    """What every check comes to, computed from the audited tables."""

    def none(table: str, offending: str) -> str:
        return f"(SELECT count(*) = 0 FROM {table} WHERE {offending})"

    early = "NOT coalesce(max_train_forecast_month < forecast_month, false)"
    rows = ["evaluated_rows"]
    return {
        "prediction_columns": _has_columns(
            predictions,
            ["category_name_english", "forecast_month", "feature_cutoff_month", "target_units", "lag_1", "lag_2", "lag_4",
             "rolling_mean_3", "naive_prediction", "champion_prediction", "max_train_forecast_month"],
        ),
        "target_period_comparability_flags": _has_columns(
            inputs, ["target_period_order_count", "is_partial_period", "is_low_volume_period", "is_comparable_period"]
        ),
        "one_forecast_month_per_prediction": none(predictions, "forecast_month IS NULL"),
        "naive_equals_lag_1": none(predictions, "NOT coalesce(abs(naive_prediction - lag_1) <= 1e-7, false)"),
        "no_train_row_reaches_validation_month": none(predictions, early),
        "fold_metric_train_cutoff": none(folds, early),
        "monthly_totals_match_predictions": _same_as(
            months, _months_of(predictions), "forecast_month", [*_TOTALS, "champion_abs_error"],
            ["forecast_month_label", "category_count", *rows],
        ),
        "category_errors_match_predictions": _same_as(
            categories, _categories_of(predictions), "category_name_english", [*_TOTALS, "absolute_error", "mae"],
            ["forecast_month_count", *rows],
        ),
        "monthly_labels_are_month_names": none(
            months, "NOT coalesce(forecast_month_label = strftime(CAST(forecast_month || '-01' AS DATE), '%b %Y'), false)"
        ),
        "reports_are_readable": none(predictions, "target_units IS NULL"),
    }


def _audit_sql() -> str:
    parts = [
        f"SELECT '{name}' AS artifacts, '{check}' AS check_name, {rule} AS passed"
        for name, tables in _AUDITED.items()
        for check, rule in _audit_rules(*tables).items()
    ]
    return sql(" UNION ALL ".join(parts), "bt_pred", "bt_folds", "bt_input", *_AUDIT_TABLES, instead=_AUDIT_TABLES)


def _metrics(shop: Shop):
    """Naive error measures over every comparable row, not only the validation months."""
    rows = backtest.comparable_rows(shop.stored_backtest_input)
    measures = backtest.regression_metrics(predicted="lag_1")
    return show(rows.agg(*measures), rounded=_METRICS)


QUERIES = {
    "backtest_input": (
        lambda shop: show(shop.backtest_input, rounded="rolling_mean_3"),
        sql(f"SELECT * EXCLUDE (rolling_mean_3), {means('rolling_mean_3')} FROM bt_input", "bt_input"),
    ),
    "validation_months": (
        lambda shop: backtest.validation_months(shop.stored_backtest_input),
        sql("SELECT forecast_month FROM bt_folds", "bt_folds"),
    ),
    "chronological_split": (
        lambda shop: backtest.chronological_split(shop.stored_backtest_input, 2)
        .groupBy("forecast_month", "is_validation")
        .agg(F.count(F.lit(1)).alias("rows")),
        sql(
            """SELECT forecast_month, forecast_month >= (SELECT min(forecast_month) FROM
              (SELECT DISTINCT forecast_month FROM bt_input ORDER BY 1 DESC LIMIT 2)) AS is_validation,
            count(*) AS rows FROM bt_input GROUP BY 1, 2""",
            "bt_input",
        ),
    ),
    "backtest_folds": (
        lambda shop: backtest.backtest_folds(shop.stored_backtest_input),
        sql(
            "SELECT CAST(fold AS INTEGER) AS fold, forecast_month, train_rows, max_train_forecast_month FROM bt_folds",
            "bt_folds",
        ),
    ),
    "naive_backtest": (
        lambda shop: show(shop.naive_predictions, rounded="rolling_mean_3"),
        sql(f"SELECT * EXCLUDE (rolling_mean_3), {means('rolling_mean_3')} FROM bt_naive", "bt_naive"),
    ),
    "gbt_backtest": (
        _boosted,
        sql(
            """SELECT category_name_english, forecast_month, fold, train_rows, max_train_forecast_month,
            target_units, naive_prediction, true AS boosted_usable FROM bt_naive""",
            "bt_naive",
        ),
    ),
    "backtest_metrics": (
        _metrics,
        sql(
            f"SELECT {_METRIC_SQL} FROM (SELECT *, lag_1 AS prediction FROM bt_input WHERE is_comparable_period)",
            "bt_input",
        ),
    ),
    "backtest_fold_metrics": (
        lambda shop: show(backtest.fold_metrics(shop.compared_predictions), rounded=_METRICS),
        sql(
            f"SELECT fold, forecast_month, model, max(train_rows) AS train_rows, count(*) AS validation_rows,"
            f" max(max_train_forecast_month) AS max_train_forecast_month, {_METRIC_SQL} FROM bt_models GROUP BY 1, 2, 3",
            "bt_models",
        ),
    ),
    "backtest_pooled_metrics": (
        lambda shop: show(backtest.pooled_metrics(shop.compared_predictions), rounded=_METRICS),
        sql(f"SELECT model, {_METRIC_SQL} FROM bt_models GROUP BY 1", "bt_models"),
    ),
    "champion": (
        lambda shop: show(
            backtest.champion(backtest.pooled_metrics(shop.compared_predictions), backtest.MOVING),
            rounded="naive_mae challenger_mae",
        ),
        sql(
            f"""SELECT CASE WHEN c.mae < n.mae AND (c.wape, c.mae, c.rmse) < (n.wape, n.mae, n.rmse)
              THEN 'moving_average' ELSE 'naive_lag_1' END AS champion_model, n.mae AS naive_mae, c.mae AS challenger_mae
            FROM (SELECT {_METRIC_SQL} FROM bt_models WHERE model = 'naive_lag_1') n,
                 (SELECT {_METRIC_SQL} FROM bt_models WHERE model = 'moving_average') c""",
            "bt_models",
        ),
    ),
    "backtest_monthly": (
        lambda shop: show(
            backtest.backtest_monthly(shop.compared_predictions),
            rounded="naive_prediction moving_average_prediction champion_prediction champion_abs_error",
        ),
        sql(
            f"""SELECT {_MONTHLY_COLUMNS} FROM (SELECT forecast_month,
            strftime(CAST(forecast_month || '-01' AS DATE), '%b %Y') AS forecast_month_label,
            sum(target_units) AS actual_units, count(*) AS evaluated_rows, count(DISTINCT category_name_english) AS category_count,
            sum(naive_prediction) AS naive_prediction, sum(moving_average_prediction) AS moving_average_prediction,
            sum(champion_prediction) AS champion_prediction,
            abs(sum(target_units) - sum(champion_prediction)) AS champion_abs_error FROM bt_pred GROUP BY 1)""",
            "bt_pred",
        ),
    ),
    "backtest_category_errors": (
        lambda shop: show(
            backtest.backtest_category_errors(shop.compared_predictions),
            rounded=_CATEGORY_ROUNDED,
        ),
        sql(_CATEGORY_SQL, "bt_pred"),
    ),
    "top_category_errors": (
        lambda shop: show(
            backtest.top_category_errors(
                backtest.backtest_category_errors(shop.compared_predictions)
            ),
            rounded=_CATEGORY_ROUNDED,
        ),
        sql(
            f"SELECT * FROM ({_CATEGORY_SQL}) ORDER BY absolute_error DESC, actual_units DESC, category_name_english LIMIT 20",
            "bt_pred",
        ),
    ),
    "backtest_audit": (
        _audit,
        _audit_sql(),
    ),
}
