"""Validation of finished tables as (check, passed) rows."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.functions.labels import UNTRANSLATED_PREFIX
from ordermill.functions.months import month_label, normalized_key, shift_key
from ordermill.operators.backtest import (
    PREDICTIONS,
    backtest_category_errors,
    backtest_monthly,
)
from ordermill.operators.orders import fulfilled, key_uniqueness
from ordermill.operators.revenue import GRAIN
from ordermill.operators.skew import join_one

RECOMPUTE_TOLERANCE = 1e-9
ARTIFACT_TOLERANCE = 1e-7
DEMAND_VALUES = ["target_units", "lag_1", "lag_2", "lag_4", "rolling_mean_3"]


def _check(name: str, verdict: DataFrame) -> DataFrame:
    """One row from a one-row, one-column boolean table."""
    return verdict.select(
        F.lit(name).alias("check_name"), F.coalesce(F.col(verdict.columns[0]), F.lit(False)).alias("passed")
    )


def _no_row(df: DataFrame, offending: Column) -> DataFrame:
    return df.agg((F.count_if(offending) == 0).alias("ok"))


def _checks_of(df: DataFrame, offending: Mapping[str, Column]) -> DataFrame:
    """Checks that hold when no row offends, all from one pass over ``df``."""
    counted = df.agg(*[F.count_if(rule).alias(f"c{i}") for i, rule in enumerate(offending.values())])
    rows = [
        F.struct(F.lit(name).alias("check_name"), (F.col(f"c{i}") == 0).alias("passed"))
        for i, name in enumerate(offending)
    ]
    return counted.select(F.inline(F.array(*rows)))


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, frames)


def verdict(checks: DataFrame) -> DataFrame:
    """PASS if every check passed."""
    return checks.agg(
        F.when(F.every("passed"), "PASS").otherwise("FAIL").alias("verdict"),
        F.count(F.lit(1)).alias("checks"),
        F.count_if(~F.col("passed")).alias("failed_checks"),
    )


def untranslated_shown(
    items: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    translation: DataFrame,
    demand: DataFrame,
) -> DataFrame:
    """Sold categories without translation and whether the demand table shows them."""
    sold_products = (
        join_one(
            items.select("order_id", "product_id"),
            fulfilled(orders).select("order_id"),
            "order_id",
            spread_on="product_id",
            how="inner",
        )
        .select("product_id")
        .distinct()
    )
    untranslated = (
        sold_products.join(products.select("product_id", "product_category_name"), "product_id")
        .select("product_category_name")
        .where(F.col("product_category_name").isNotNull())
        .distinct()
        .join(
            translation.where(F.col("product_category_name_english").isNotNull()),
            "product_category_name",
            "left_anti",
        )
    )
    expected = untranslated.select(
        F.concat(F.lit(UNTRANSLATED_PREFIX), "product_category_name").alias("category_name_english")
    )
    shown = (
        demand.where(F.col("category_name_english").startswith(UNTRANSLATED_PREFIX))
        .select("category_name_english", F.lit(True).alias("is_shown"))
        .distinct()
    )
    return expected.join(shown, "category_name_english", "left").withColumn(
        "is_shown", F.coalesce("is_shown", F.lit(False))
    )


def silver_checks(
    tables: Mapping[str, DataFrame],
    products: DataFrame,
    translation: DataFrame,
    expected_rows: Mapping[str, int] | None = None,
) -> DataFrame:
    """Checks of the cleaned and joined tables; row counts only where expected ones are given."""
    orders, master = tables["orders"], tables["master_orders"]
    order_keys = key_uniqueness(orders, "order_id")
    master_keys = key_uniqueness(master, "order_id")
    orders_seen = order_keys.select("row_count").scalar()
    untranslated = untranslated_shown(
        tables["order_items"], orders, products, translation, tables["product_demand"]
    )
    revenue = F.col("total_revenue")
    parts = [
        _check("orders_unique_order_id", order_keys.select("is_unique")),
        _check("master_orders_unique_order_id", master_keys.select("is_unique")),
        _check("master_orders_keeps_all_orders", master_keys.select(F.col("row_count") == orders_seen)),
        _check(
            "customer_profile_unique_customer",
            key_uniqueness(tables["customer_profile"], "customer_unique_id").select("is_unique"),
        ),
        _check(
            "product_demand_category_not_null",
            _no_row(tables["product_demand"], F.col("category_name_english").isNull()),
        ),
        _check("unmatched_categories_preserved", _no_row(untranslated, ~F.col("is_shown"))),
        _check(
            "seller_revenue_non_negative",
            _no_row(tables["seller_performance"], revenue.isNull() | (revenue < 0)),
        ),
    ]
    for name, rows in (expected_rows or {}).items():
        parts.append(_check(f"{name}_{rows}_rows", tables[name].agg(F.count(F.lit(1)) == rows)))
    return _stack(parts)


def recomputed_demand_features(demand: DataFrame) -> DataFrame:
    """Demand features computed a second way: neighbours are found by row number
    and self-joined on category and number instead of read through a window."""
    numbered = demand.select(
        "category_name_english",
        "order_year_month",
        "monthly_units",
        F.row_number()
        .over(Window.partitionBy("category_name_english").orderBy("order_year_month"))
        .alias("place"),
    )

    def neighbour(offset: int, name: str) -> DataFrame:
        return numbered.select(
            "category_name_english",
            (F.col("place") - offset).alias("place"),
            F.col("monthly_units").alias(name),
        )

    key = ["category_name_english", "place"]
    joined = numbered
    for offset, name in ((1, "target"), (-1, "u1"), (-2, "u2"), (-3, "u3")):
        joined = joined.join(neighbour(offset, name), key)
    units = F.col("monthly_units")
    return joined.select(
        "category_name_english",
        shift_key("order_year_month", 1).alias("forecast_month"),
        F.col("target").alias("target_units"),
        units.alias("lag_1"),
        F.col("u1").alias("lag_2"),
        F.col("u3").alias("lag_4"),
        ((units + F.col("u1") + F.col("u2")) / 3).alias("rolling_mean_3"),
    )


DIGEST_RANGES = 4096


def _signed_hashes(df: DataFrame, keys: list[str], values: list[str], sign: int) -> DataFrame:
    """Keys with the hash of their row, and whether a cell is missing; ``sign`` tells the tables apart."""
    numbers = [F.col(name).cast("double") for name in values]
    missing = F.lit(False)
    for cell in [*numbers, *[F.col(key) for key in keys]]:  # a missing key meets no other
        missing = missing | cell.isNull()
    cells = [*keys, *[F.col(key).isNull() for key in keys], *numbers, *[number.isNull() for number in numbers]]
    return df.select(
        *keys,
        F.lit(sign).alias("_sign"),
        (F.xxhash64(*cells).cast("decimal(20,0)") * sign).alias("_hash"),
        missing.alias("_missing"),
        F.pmod(F.xxhash64(*keys), F.lit(DIGEST_RANGES)).cast("int").alias("_range"),
    )


def _unbalanced(rows: DataFrame, by: list[str]) -> DataFrame:
    """Groups whose rows are not the same on both sides, or lack a value."""
    sums = rows.groupBy(*by).agg(F.sum("_sign").alias("_rows"), F.sum("_hash").alias("_hashes"), F.bool_or("_missing").alias("_holes"))
    return sums.where((F.col("_rows") != 0) | (F.col("_hashes") != 0) | F.col("_holes")).select(*by)


def suspect_keys(actual: DataFrame, expected: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Keys whose rows are not exactly alike in both tables; each key stands once in a table.

    Two levels of order-free sums of row hashes: first over ``DIGEST_RANGES``
    ranges of keys, merged before the shuffle, then over the keys of those
    ranges alone that differ. Alike tables shuffle nothing but the first sums.
    """
    rows = _signed_hashes(actual, keys, values, 1).unionAll(_signed_hashes(expected, keys, values, -1))
    ranges = F.broadcast(_unbalanced(rows, ["_range"]))  # DIGEST_RANGES rows at most
    return _unbalanced(rows.join(ranges, "_range", "left_semi"), keys)


def differences(
    actual: DataFrame,
    expected: DataFrame,
    keys: list[str],
    values: list[str],
    tolerance: float = RECOMPUTE_TOLERANCE,
) -> DataFrame:
    """Keys on one side only, or with a value that is missing or differs.

    Only rows with ``suspect_keys`` are joined: sums of hashes settle all others.
    """
    suspects = suspect_keys(actual, expected, keys, values)
    same = lambda df: reduce(
        lambda a, b: a & b, [df[key].eqNullSafe(suspects[key]) for key in keys]
    )
    left = actual.join(suspects, same(actual), "left_semi").select(*keys, *values)
    right = expected.join(suspects, same(expected), "left_semi").select(
        *keys, *[F.col(name).alias(f"expected_{name}") for name in values]
    )
    wrong = F.lit(False)
    for name in values:
        ours, theirs = F.col(name), F.col(f"expected_{name}")
        wrong = wrong | ours.isNull() | theirs.isNull() | (F.abs(ours - theirs) > tolerance)
    return left.join(right, keys, "full").where(wrong)


def _demand_checks(features: DataFrame, demand: DataFrame) -> list[DataFrame]:
    absent = F.lit(False)
    for name in DEMAND_VALUES:
        absent = absent | F.col(name).isNull()
    expected = recomputed_demand_features(demand)
    key = ["category_name_english", "forecast_month"]
    expected_rows = expected.agg(F.count(F.lit(1)).alias("n")).scalar()
    wrong = differences(features, expected, key, DEMAND_VALUES)
    return [
        _check("demand_required_fields_not_null", _no_row(features, absent)),
        _check("demand_features_match_recompute", wrong.agg(F.count(F.lit(1)) == 0)),
        _check(
            "demand_row_count_matches_recompute",
            features.agg((F.count(F.lit(1)) == expected_rows).alias("ok")),
        ),
    ]


def date_leaks(churn: DataFrame) -> DataFrame:
    """Panel rows that know something from after their snapshot."""
    latest = F.greatest(
        F.to_date("last_purchase_timestamp"),
        F.to_date("last_review_creation_date"),
        F.to_date("last_delivery_date"),
    )
    return churn.where(latest > F.col("snapshot_date"))


def calendar_lag_errors(features: DataFrame) -> DataFrame:
    """Rows whose lag does not come from exactly that many calendar months before."""
    wrong = F.lit(False)
    for n in (1, 2, 4):
        distance = F.months_between("forecast_month", f"lag_{n}_source_month")
        wrong = wrong | (distance != n)
    return features.where(wrong)


def calendar_checks(features: DataFrame) -> DataFrame:
    absent = F.lit(False)
    for name in DEMAND_VALUES:
        absent = absent | F.col(name).isNull()
    rules = {"calendar_features_not_null": absent}
    for n in (1, 2, 4):
        distance = F.months_between("forecast_month", f"lag_{n}_source_month")
        rules[f"lag_{n}_is_{n}_months_back"] = distance != n
    rules["comparability_known"] = F.col("target_period_comparable").isNull()
    has_rows = features.agg((F.count(F.lit(1)) > 0).alias("ok"))
    return _checks_of(features, rules).unionAll(_check("calendar_features_not_empty", has_rows))


def bi_grain(bi: DataFrame, master: DataFrame) -> DataFrame:
    """Rows of the revenue table against distinct key combinations of the orders."""
    groups = master.select(*GRAIN).distinct().agg(F.count(F.lit(1)).alias("n")).scalar()
    rows = bi.agg(F.count(F.lit(1)).alias("bi_rows")).withColumn("expected_groups", groups)
    return rows.withColumn("matches", F.col("bi_rows") == F.col("expected_groups"))


def gold_checks(
    tables: Mapping[str, DataFrame], demand: DataFrame, profile: DataFrame, master: DataFrame
) -> DataFrame:
    """Checks of the feature and report tables."""
    churn, rfm, bi = tables["churn_features"], tables["rfm_segments"], tables["bi_revenue"]
    has = lambda df, name: F.lit(name in df.columns)
    scores = ["recency_score", "frequency_score", "monetary_score"]
    off_scale = F.lit(False)
    for name in scores:
        off_scale = off_scale | ~F.col(name).between(1, 5)
    customers = profile.agg(F.count(F.lit(1)).alias("n")).scalar()
    leak_free = date_leaks(churn).agg(F.count(F.lit(1)) == 0)
    late = F.col("late_delivery_rate")
    return _stack(
        [
            *_demand_checks(tables["demand_features"], demand),
            _check("churn_has_snapshot_date", churn.agg(has(churn, "snapshot_date").alias("ok"))),
            _check(
                "churn_has_both_target_classes",
                churn.agg((F.min("is_churned") != F.max("is_churned")).alias("ok")),
            ),
            _check("churn_feature_dates_not_after_snapshot", leak_free),
            _checks_of(
                rfm,
                {
                    "rfm_scores_between_1_and_5": off_scale,
                    "rfm_total_between_3_and_15": ~F.col("rfm_total").between(3, 15),
                    "rfm_segment_label_not_null": F.col("segment_label").isNull(),
                },
            ),
            _check(
                "rfm_keeps_all_customers",
                rfm.agg((F.count(F.lit(1)) == customers).alias("ok")),
            ),
            _checks_of(
                bi,
                {
                    "bi_revenue_non_negative": F.col("total_revenue").isNull()
                    | (F.col("total_revenue") < 0)
                    | (F.col("avg_order_value") < 0),
                    "bi_late_rate_between_0_and_1": ~late.between(0, 1),
                    "bi_orders_non_negative": F.col("total_orders") < 0,
                },
            ),
            _check(
                "bi_has_late_delivery_rate",
                bi.agg((has(bi, "late_delivery_rate") & ~has(bi, "return_rate")).alias("ok")),
            ),
            _check("bi_one_row_per_group", bi_grain(bi, master).select("matches")),
        ]
    )


def _same_table(
    actual: DataFrame, expected: DataFrame, key: str, numbers: list[str], texts: list[str]
) -> DataFrame:
    """True when both tables have the same keys, near-equal numbers and equal texts."""
    wanted = [key, *numbers, *texts]
    right = expected.select(
        F.col(key), *[F.col(name).alias(f"expected_{name}") for name in [*numbers, *texts]],
        F.lit(True).alias("_right"),
    )
    left = actual.select(*wanted, F.lit(True).alias("_left"))
    same = F.col("_left").isNotNull() & F.col("_right").isNotNull()
    for name in numbers:
        gap = F.abs(F.col(name).cast("double") - F.col(f"expected_{name}").cast("double"))
        same = same & F.coalesce(gap <= ARTIFACT_TOLERANCE, F.lit(False))
    for name in texts:
        same = same & F.col(name).cast("string").eqNullSafe(F.col(f"expected_{name}").cast("string"))
    return left.join(right, key, "full").agg((F.count_if(~same) == 0).alias("ok"))


def backtest_audit(
    predictions: DataFrame,
    monthly: DataFrame,
    category_errors: DataFrame,
    fold_metrics: DataFrame,
    inputs: DataFrame,
) -> DataFrame:
    """Checks of stored backtest results against the prediction rows they came from."""
    guesses = [name for name in PREDICTIONS.values() if name in predictions.columns]
    numbers = ["actual_units", *guesses, "champion_prediction"]
    needed = {
        "category_name_english", "forecast_month", "feature_cutoff_month", "target_units",
        "lag_1", "lag_2", "lag_4", "rolling_mean_3", "naive_prediction",
        "champion_prediction", "max_train_forecast_month",
    }
    flags = {
        "target_period_order_count", "is_partial_period", "is_low_volume_period",
        "is_comparable_period",
    }

    def known(present: bool, name: str) -> DataFrame:
        one = predictions.sparkSession.range(1)
        return _check(name, one.select(F.lit(present).alias("ok")))

    month = normalized_key("forecast_month")
    trained = normalized_key("max_train_forecast_month")
    gap = F.abs(F.col("naive_prediction") - F.col("lag_1"))
    label = month_label("forecast_month")
    parts = [
        known(needed <= set(predictions.columns), "prediction_columns"),
        known(flags <= set(inputs.columns), "target_period_comparability_flags"),
        _checks_of(
            predictions,
            {
                "one_forecast_month_per_prediction": month.isNull(),
                "naive_equals_lag_1": ~F.coalesce(gap <= ARTIFACT_TOLERANCE, F.lit(False)),
                "no_train_row_reaches_validation_month": ~F.coalesce(trained < month, F.lit(False)),
            },
        ),
        _check(
            "fold_metric_train_cutoff",
            _no_row(fold_metrics, ~F.coalesce(trained < month, F.lit(False))),
        ),
        _check(
            "monthly_totals_match_predictions",
            _same_table(
                monthly,
                backtest_monthly(predictions),
                "forecast_month",
                [*numbers, "champion_abs_error"],
                ["forecast_month_label", "evaluated_rows", "category_count"],
            ),
        ),
        _check(
            "category_errors_match_predictions",
            _same_table(
                category_errors,
                backtest_category_errors(predictions),
                "category_name_english",
                [*numbers, "absolute_error", "mae"],
                ["evaluated_rows", "forecast_month_count"],
            ),
        ),
        _check(
            "monthly_labels_are_month_names",
            _no_row(
                monthly,
                ~F.coalesce(
                    F.col("forecast_month_label").rlike(r"^[A-Z][a-z]{2} \d{4}$")
                    & (F.col("forecast_month_label") == label),
                    F.lit(False),
                ),
            ),
        ),
    ]
    return _stack(parts)


def data_quality_summary(
    audit: DataFrame, counts: DataFrame, coverage: DataFrame, gap: DataFrame | None = None
) -> DataFrame:
    """Audit verdict with its findings, translation gap, row counts of all layers and
    excluded months with both flags, as (topic, item, value) rows."""

    def rows(df: DataFrame, topic: str, item: Column, value: Column) -> DataFrame:
        return df.select(
            F.lit(topic).alias("topic"), item.alias("item"), value.cast("string").alias("value")
        )

    excluded = coverage.where(~F.col("is_comparable_period"))
    why = F.concat(
        F.lit("orders="), "order_count", F.lit(" partial="), "is_partial_period",
        F.lit(" low_volume="), "is_low_volume_period",
    )
    verdict_items = ("executive_verdict", "safe_to_run", "fatal_checks", "warning_checks")
    parts = [rows(audit, "source_audit", F.lit(item), F.col(item)) for item in verdict_items]
    if gap is not None:
        parts += [
            rows(gap, "translation_gap", F.lit("product_rows"), F.col("unmatched_product_row_count")),
            rows(gap, "translation_gap", F.lit("categories"), F.col("unmatched_distinct_category_count")),
        ]
    parts += [
        rows(counts, "row_count", F.concat_ws("/", "layer", "table_name"), F.col("row_count")),
        rows(excluded, "excluded_period", F.col("order_year_month"), why),
    ]
    return _stack(parts)
