"""Rolling-origin backtest of monthly demand forecasts."""

from __future__ import annotations

import warnings
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from ordermill.functions.months import month_label, normalized_key, shift_key
from ordermill.functions.numeric import non_negative, ratio

FEATURES = ["lag_1", "lag_2", "lag_4", "rolling_mean_3", "month_num", "is_q4"]
TARGET = "target_units"
# Validation months needed, wanted and used at most.
FEWEST_MONTHS, MIN_MONTHS, MAX_MONTHS = 2, 4, 6
TRAIN_PARTITIONS = 4  # part of the model: another number draws other samples
QUALITY = ["is_partial_period", "is_low_volume_period", "is_comparable_period"]
NAIVE, BOOSTED, MOVING = "naive_lag_1", "boosted_trees", "moving_average"
PREDICTIONS = {
    NAIVE: "naive_prediction",
    BOOSTED: "boosted_prediction",
    MOVING: "moving_average_prediction",
}
# Size and rate of the boosted model.
BOOSTED_PARAMS = {
    "maxIter": 120,
    "maxDepth": 3,
    "stepSize": 0.05,
    "subsamplingRate": 0.8,
    "featureSubsetStrategy": "0.8",
    "seed": 42,
}


def _require_columns(df: DataFrame, needed: list[str]) -> None:
    missing = [name for name in needed if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def backtest_input(features: DataFrame, coverage: DataFrame) -> DataFrame:
    """Feature rows next to the order count and quality of the predicted month.

    A month without coverage counts as not comparable, with no orders.
    """
    wanted = ["category_name_english", "forecast_month", "feature_cutoff_month", TARGET, *FEATURES]
    _require_columns(features, wanted)
    target_month = coverage.select(
        F.col("order_year_month").alias("forecast_month"),
        F.col("order_count").alias("target_period_order_count"),
        *QUALITY,
    )
    known = {name: F.coalesce(name, F.lit(False)) for name in QUALITY}
    known["target_period_order_count"] = F.coalesce(
        "target_period_order_count", F.lit(0).cast("bigint")
    )
    return (
        features.select(*wanted)
        .join(target_month, "forecast_month", "left")
        .withColumns(known)
    )


def prepare_backtest_input(df: DataFrame) -> DataFrame:
    """Typed rows ready for modelling; rows with an unreadable number are dropped.

    Absent flags are read as "not partial, not low volume".
    """
    _require_columns(df, ["category_name_english", "forecast_month", TARGET, *FEATURES])
    month = normalized_key("forecast_month")
    if "feature_cutoff_month" in df.columns:
        cutoff = normalized_key("feature_cutoff_month")
    else:
        cutoff = shift_key(month, -1)
    columns = {
        "forecast_month": month,
        "feature_cutoff_month": cutoff,
        "category_name_english": F.col("category_name_english").cast("string"),
        **{name: F.col(name).try_cast("double") for name in [TARGET, *FEATURES]},
    }
    for name in ("is_partial_period", "is_low_volume_period"):
        present = F.col(name).cast("boolean") if name in df.columns else F.lit(False)
        columns[name] = F.coalesce(present, F.lit(False))
    if "target_period_order_count" not in df.columns:
        columns["target_period_order_count"] = F.lit(None).cast("bigint")
    prepared = df.withColumns(columns)
    if "is_comparable_period" in df.columns:
        comparable = F.coalesce(F.col("is_comparable_period").cast("boolean"), F.lit(False))
    else:
        comparable = ~(F.col("is_partial_period") | F.col("is_low_volume_period"))
    return prepared.withColumn("is_comparable_period", comparable).dropna(
        subset=[TARGET, *FEATURES]
    )


def dropped_rows(df: DataFrame) -> DataFrame:
    """How many rows ``prepare_backtest_input`` leaves out, next to how many it keeps."""
    numbers = [F.col(name).try_cast("double").isNotNull() for name in [TARGET, *FEATURES]]
    usable = reduce(lambda a, b: a & b, numbers)
    return df.agg(
        F.count_if(~usable).alias("dropped_rows"), F.count_if(usable).alias("kept_rows")
    )


def require_rows(prepared: DataFrame) -> DataFrame:
    """``prepared`` itself, after checking that there is something to model."""
    if prepared.isEmpty():
        raise ValueError("no usable modelling rows")
    return prepared


def comparable_rows(features: DataFrame) -> DataFrame:
    if "is_comparable_period" not in features.columns:
        return features
    return features.where("is_comparable_period")


def validation_months(features: DataFrame, most: int = MAX_MONTHS) -> DataFrame:
    """The last comparable months, at most ``most`` of them."""
    return (
        comparable_rows(features)
        .select("forecast_month")
        .where(F.col("forecast_month").isNotNull())
        .distinct()
        .orderBy(F.desc("forecast_month"))
        .limit(most)
    )


def chronological_split(features: DataFrame, months: int = 2) -> DataFrame:
    """Add ``is_validation``: true for the rows of the last ``months`` months."""
    if months < 1:
        raise ValueError("at least one validation month is needed")
    ordered = features.select("forecast_month").distinct().orderBy(F.desc("forecast_month"))
    last = [row[0] for row in ordered.limit(months + 1).collect()]
    if len(last) <= months:
        raise ValueError(f"{len(last)} months cannot be split with {months} for validation")
    return features.withColumn("is_validation", F.col("forecast_month") >= last[months - 1])


def backtest_folds(features: DataFrame, most: int = MAX_MONTHS) -> DataFrame:
    """One row per fold: its month and the size and end of its training data.

    Every fold trains on all comparable rows before its month, so the training
    figures are running totals over the month list.
    """
    months = (
        comparable_rows(features)
        .groupBy("forecast_month")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    # One row per calendar month from here on.
    before = Window.orderBy("forecast_month").rowsBetween(Window.unboundedPreceding, -1)
    recent = Window.orderBy(F.desc("forecast_month"))
    dated = months.select(
        "forecast_month",
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("train_rows"),
        F.max("forecast_month").over(before).alias("max_train_forecast_month"),
        F.row_number().over(recent).alias("age"),
    )
    fold = F.row_number().over(Window.orderBy("forecast_month"))
    return dated.where(F.col("age") <= most).select(
        fold.alias("fold"), "forecast_month", "train_rows", "max_train_forecast_month"
    )


def require_folds(folds: DataFrame, fewest: int = FEWEST_MONTHS) -> list:
    """The fold rows (at most ``MAX_MONTHS``), after checking that each can train.

    Fewer than ``fewest`` are refused; fewer than ``MIN_MONTHS`` are warned about.
    """
    rows = folds.orderBy("fold").collect()
    if len(rows) < fewest:
        raise ValueError("not enough comparable months for a rolling backtest")
    if len(rows) < MIN_MONTHS:
        warnings.warn(f"only {len(rows)} comparable months for validation", stacklevel=2)
    untrained = [row["forecast_month"] for row in rows if row["train_rows"] == 0]
    if untrained:
        raise ValueError(f"no training rows before {untrained}")
    return rows


def naive_backtest(features: DataFrame, most: int = MAX_MONTHS) -> DataFrame:
    """Out-of-fold rows predicted by the previous month, all folds in one plan."""
    folds = backtest_folds(features, most)
    require_folds(folds)
    folds = F.broadcast(folds)
    return (
        comparable_rows(features)
        .join(folds, "forecast_month")
        .withColumn("naive_prediction", non_negative("lag_1"))
    )


def can_be_tested(features: DataFrame, most: int = MAX_MONTHS, fewest: int = FEWEST_MONTHS) -> bool:
    """Whether ``require_folds`` would accept the months of ``features``."""
    rows = backtest_folds(features, most).collect()
    return len(rows) >= fewest and all(row["train_rows"] for row in rows)


def no_predictions(features: DataFrame) -> DataFrame:
    """The table of ``boosted_backtest`` without rows."""
    return features.limit(0).selectExpr(
        "*", "0 fold", "0L train_rows", "'' max_train_forecast_month", "0D naive_prediction", "0D boosted_prediction"
    )


def boosted_backtest(
    features: DataFrame,
    most: int = MAX_MONTHS,
    params: dict | None = None,
    partitions: int = TRAIN_PARTITIONS,
    model_path: str | None = None,
) -> DataFrame:
    """The naive rows plus the prediction of boosted trees trained before each month.

    The folds (at most ``most``) are independent and are fitted at the same
    time. The trees sample rows by their place, so every training row has a
    fixed one: dealt to ``partitions`` by a hash of category and month, and
    sorted inside. The forecasts are the same however ``features`` is
    partitioned. With ``model_path`` the model of every fold is stored below
    it and scoring uses what was stored.
    """
    usable = comparable_rows(features)
    folds = require_folds(backtest_folds(features, most))
    learner = GBTRegressor(
        featuresCol="_features",
        labelCol=TARGET,
        predictionCol="_boosted",
        **{**BOOSTED_PARAMS, **(params or {})},
    )
    numeric = usable.withColumns({name: F.col(name).cast("double") for name in [TARGET, *FEATURES]})
    rows = VectorAssembler(inputCols=FEATURES, outputCol="_features").transform(numeric)
    month = F.col("forecast_month")
    place = ["category_name_english", "forecast_month"]
    order = [*place, TARGET, *FEATURES]
    training = rows.select(*order, "_features").repartition(partitions, *place).sortWithinPartitions(*order).persist()

    def fitted(fold) -> GBTRegressionModel:
        model = learner.fit(training.where(month < fold["forecast_month"]))
        if model_path is None:
            return model
        path = f"{model_path}/fold={fold['fold']}"
        model.write().overwrite().save(path)
        return GBTRegressionModel.load(path)

    try:
        fit = inheritable_thread_target(rows.sparkSession)(fitted)
        with ThreadPoolExecutor(len(folds)) as pool:
            models = list(pool.map(fit, folds))
    finally:
        training.unpersist()

    def predicted(fold, model) -> DataFrame:
        return (
            model.transform(rows.where(month == fold["forecast_month"]))
            .withColumns(
                {
                    "fold": F.lit(fold["fold"]),
                    "train_rows": F.lit(fold["train_rows"]).cast("bigint"),
                    "max_train_forecast_month": F.lit(fold["max_train_forecast_month"]),
                    "naive_prediction": non_negative("lag_1"),
                    "boosted_prediction": non_negative("_boosted"),
                }
            )
            .drop("_features", "_boosted")
        )

    return reduce(DataFrame.unionAll, [predicted(*pair) for pair in zip(folds, models)])


def regression_metrics(actual: str = TARGET, predicted: str = "prediction") -> list[Column]:
    """Error measures as aggregates; percentages never divide by zero."""
    y, guess = F.col(actual).cast("double"), F.col(predicted).cast("double")
    miss, size = F.abs(y - guess), F.abs(y)
    both = size + F.abs(guess)
    spread = F.var_pop(y) * F.count(y)
    return [
        F.avg(miss).alias("mae"),
        F.sqrt(F.avg(miss * miss)).alias("rmse"),
        (F.sum(miss) / F.greatest(F.sum(size), F.lit(1.0)) * 100).alias("wape"),
        (F.avg(2.0 * miss / F.when(both < 1e-12, 1.0).otherwise(both)) * 100).alias("smape"),
        (F.avg(miss / F.when(size < 1e-12, 1.0).otherwise(size)) * 100).alias("mape"),
        F.when(spread > 1e-12, 1.0 - F.sum(miss * miss) / spread).otherwise(0.0).alias("r2"),
    ]


def by_model(predictions: DataFrame) -> DataFrame:
    """One row per prediction and model, as ``model`` and ``prediction``."""
    present = {m: c for m, c in PREDICTIONS.items() if c in predictions.columns}
    pairs = F.array(
        *[
            F.struct(F.lit(m).alias("model"), F.col(c).alias("prediction"))
            for m, c in present.items()
        ]
    )
    return predictions.withColumn("_pair", F.explode(pairs)).select(
        *[c for c in predictions.columns if c not in present.values()], "_pair.*"
    )


def fold_metrics(predictions: DataFrame) -> DataFrame:
    return by_model(predictions).groupBy("fold", "forecast_month", "model").agg(
        F.max("train_rows").alias("train_rows"),
        F.count(F.lit(1)).alias("validation_rows"),
        F.max("max_train_forecast_month").alias("max_train_forecast_month"),
        *regression_metrics(),
    )


def pooled_metrics(predictions: DataFrame) -> DataFrame:
    return by_model(predictions).groupBy("model").agg(*regression_metrics())


def model_metrics(predictions: DataFrame, challenger: str = BOOSTED) -> DataFrame:
    """Pooled error measures per model, with the size of the test and whether the model is the champion."""
    pooled = pooled_metrics(predictions)
    tested = predictions.agg(
        F.count(F.lit(1)).alias("evaluated_rows"), F.countDistinct("forecast_month").alias("validation_months")
    )
    best = champion(pooled, challenger).select("champion_model").scalar()
    return pooled.join(tested).withColumn("is_champion", F.col("model") == best).orderBy("model")


def champion(pooled: DataFrame, challenger: str = BOOSTED) -> DataFrame:
    """The naive model, unless the challenger has a lower MAE and is lower
    in (WAPE, MAE, RMSE) order as well. ``pooled`` has one row per model."""
    ranking = F.struct("wape", "mae", "rmse")

    def of(model: str, value: Column) -> Column:
        return F.max(F.when(F.col("model") == model, value))

    both = pooled.agg(
        of(NAIVE, F.col("mae")).alias("naive_mae"),
        of(challenger, F.col("mae")).alias("challenger_mae"),
        of(NAIVE, ranking).alias("naive_rank"),
        of(challenger, ranking).alias("challenger_rank"),
    )
    better = (F.col("challenger_mae") < F.col("naive_mae")) & (
        F.col("challenger_rank") < F.col("naive_rank")
    )
    return both.select(
        F.when(better, challenger).otherwise(NAIVE).alias("champion_model"),
        "naive_mae",
        "challenger_mae",
    )


def with_champion(predictions: DataFrame, challenger: str = BOOSTED) -> DataFrame:
    """Add the forecasts of the model that ``champion`` picks for these predictions."""
    best = champion(pooled_metrics(predictions), challenger).select("champion_model").scalar()
    return predictions.withColumn(
        "champion_prediction",
        F.when(best == challenger, F.col(PREDICTIONS[challenger])).otherwise(F.col(PREDICTIONS[NAIVE])),
    )


def _totals(predictions: DataFrame) -> list[Column]:
    guesses = [*PREDICTIONS.values(), "champion_prediction"]
    present = [name for name in guesses if name in predictions.columns]
    return [
        F.sum(TARGET).alias("actual_units"),
        *[F.sum(name).alias(name) for name in present],
    ]


def backtest_monthly(predictions: DataFrame) -> DataFrame:
    """Actual and predicted totals per month and the error of the total."""
    return (
        predictions.groupBy("forecast_month")
        .agg(
            *_totals(predictions),
            F.count(F.lit(1)).alias("evaluated_rows"),
            F.countDistinct("category_name_english").alias("category_count"),
        )
        .withColumns(
            {
                "forecast_month_label": month_label("forecast_month"),
                "champion_abs_error": F.abs(F.col("actual_units") - F.col("champion_prediction")),
            }
        )
        .orderBy("forecast_month")
    )


def _largest_errors() -> list[Column]:
    """Order of the error tables; sums of fractions are compared to six digits."""
    return [F.desc(F.round("absolute_error", 6)), F.desc("actual_units"), F.asc("category_name_english")]


def backtest_category_errors(predictions: DataFrame) -> DataFrame:
    """Summed absolute errors per category, largest first."""
    return (
        predictions.groupBy("category_name_english")
        .agg(
            *_totals(predictions),
            F.sum(F.abs(F.col(TARGET) - F.col("champion_prediction"))).alias("absolute_error"),
            F.count(F.lit(1)).alias("evaluated_rows"),
            F.countDistinct("forecast_month").alias("forecast_month_count"),
        )
        .withColumn("mae", ratio("absolute_error", F.greatest("evaluated_rows", F.lit(1))))
        .orderBy(*_largest_errors())
    )


def top_category_errors(errors: DataFrame, n: int = 20) -> DataFrame:
    return errors.orderBy(*_largest_errors()).limit(n)
