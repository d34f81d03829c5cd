from __future__ import annotations

from datetime import date
from datetime import datetime as dt

from ordermill.functions.months import month_label, normalized_key
from ordermill.operators import checks, demand, orders, periods


def series(spark, pairs):
    return spark.createDataFrame(
        [("a", month, units, float(units), 1.0) for month, units in pairs],
        "category_name_english string, order_year_month string, monthly_units long,"
        " monthly_revenue double, avg_price double",
    )


MONTHS = [(f"2018-{m:02d}", m * 10) for m in range(1, 7)]


def test_only_fulfilled_orders_and_three_category_labels(spark):
    base = spark.createDataFrame(
        [
            ("o1", "delivered", dt(2018, 1, 2)), ("o2", "delivered", dt(2018, 1, 3)),
            ("o3", "delivered", dt(2018, 1, 4)), ("o4", "canceled", dt(2018, 1, 4)),
            ("o5", "delivered", None),
        ],
        "order_id string, order_status string, order_purchase_timestamp timestamp",
    ).selectExpr("*", "date_format(order_purchase_timestamp, 'yyyy-MM') AS order_year_month")
    items = spark.createDataFrame(
        [(f"o{i}", 1, p, 10.0) for i, p in enumerate(["p1", "p2", "p3", "p2", "p2"], 1)],
        "order_id string, order_item_id int, product_id string, price double",
    )
    products = spark.createDataFrame(
        [("p1", "beleza"), ("p2", "sem_traducao"), ("p3", None)],
        "product_id string, product_category_name string",
    )
    words = spark.createDataFrame(
        [("beleza", "beauty")], "product_category_name string, product_category_name_english string"
    )
    sold = demand.product_demand(items, base, products, words).collect()
    assert {r["category_name_english"]: r["monthly_units"] for r in sold} == {
        "beauty": 1, "untranslated__sem_traducao": 1, "unknown": 1,
    }


def test_growth_over_the_previous_observed_month(spark):
    rows = demand.with_growth(series(spark, [("2018-01", 10), ("2018-03", 15)]).drop("x"))
    seen = {r["order_year_month"]: (r["prev_month"], r["mom_growth"]) for r in rows.collect()}
    assert seen == {"2018-01": (None, 0.0), "2018-03": (10, 50.0)}


def test_row_lag_features(spark):
    rows = {r["forecast_month"]: r for r in demand.demand_features(series(spark, MONTHS)).collect()}
    assert set(rows) == {"2018-05", "2018-06"}
    june = rows["2018-06"]
    assert june["feature_cutoff_month"] == "2018-05"
    assert [june[c] for c in ("target_units", "lag_1", "lag_2", "lag_4")] == [60, 50, 40, 20]
    assert june["rolling_mean_3"] == 40.0 and june["month_num"] == 6 and june["is_q4"] == 0


def facts(spark, months, per_month=2):
    rows = [
        (f"{m}-{i}", "delivered", dt.strptime(m, "%Y-%m"), m) for m in months for i in range(per_month)
    ]
    return spark.createDataFrame(
        rows, "order_id string, order_status string, order_purchase_timestamp timestamp, order_year_month string"
    )


def test_calendar_lags_differ_from_row_lags_at_a_gap(spark):
    gappy = series(spark, [(m, u) for m, u in MONTHS if m != "2018-04"])
    master = facts(spark, [m for m, _ in MONTHS if m != "2018-04"])
    calendar = demand.demand_features_calendar(gappy, master, min_orders=1)
    rows = {r["order_year_month"]: r for r in calendar.collect()}
    assert set(rows) == {"2018-05", "2018-06"}
    may = rows["2018-05"]
    assert (may["lag_1"], may["lag_2"], may["lag_4"]) == (0.0, 30.0, 10.0)
    assert may["rolling_mean_3"] == (20 + 30 + 0) / 3
    assert may["lag_4_source_month"] == date(2018, 1, 1)
    assert may["target_period_comparable"] and not rows["2018-06"]["target_period_comparable"]
    assert checks.calendar_lag_errors(calendar).count() == 0
    row_lags = {r["forecast_month"]: r["lag_1"] for r in demand.demand_features(gappy).collect()}
    assert row_lags == {"2018-06": 50}


def test_month_without_orders_is_not_comparable(spark):
    gappy = series(spark, [(m, u) for m, u in MONTHS if m != "2018-05"])
    master = facts(spark, ["2018-01", "2018-06"])
    rows = demand.demand_features_calendar(gappy, master, min_orders=1).collect()
    may = next(r for r in rows if r["order_year_month"] == "2018-05")
    assert may["order_count"] == 0 and may["is_partial_period"] and may["is_low_volume_period"]


def test_rolling_mean_of_three_prior_months(spark):
    rows = demand.demand_features_calendar(
        series(spark, MONTHS), facts(spark, ["2018-01"]), min_orders=1
    ).collect()
    assert {r["order_year_month"]: r["rolling_mean_3"] for r in rows} == {"2018-05": 30.0, "2018-06": 40.0}


def test_cutoff_month(spark):
    def cutoff(day):
        df = spark.createDataFrame([(day,)], "order_purchase_timestamp timestamp")
        return demand.demand_cutoff_month(df).first()[0]

    assert cutoff(dt(2018, 10, 17)) == "2018-09"
    assert cutoff(dt(2018, 1, 9)) == "2017-12"


def test_recompute_finds_a_wrong_value(spark):
    base = series(spark, MONTHS)
    keys = ["category_name_english", "forecast_month"]
    right = demand.demand_features(base)
    again = checks.recomputed_demand_features(base)
    assert checks.differences(right, again, keys, checks.DEMAND_VALUES).count() == 0
    wrong = right.selectExpr("* EXCEPT (lag_2)", "lag_2 + 1 AS lag_2")
    assert checks.differences(wrong, again, keys, checks.DEMAND_VALUES).count() == 2
    missing = right.where("forecast_month = '2018-05'")
    assert checks.differences(missing, again, keys, checks.DEMAND_VALUES).count() == 1


def test_period_quality(spark):
    monthly = spark.createDataFrame(
        [
            ("2018-08", 500, dt(2018, 8, 1), dt(2018, 8, 31)),
            ("2018-09", 16, dt(2018, 9, 2), dt(2018, 9, 20)),
            ("2018-10", 4, dt(2018, 10, 1), dt(2018, 10, 17)),
        ],
        "order_year_month string, order_count long, first_purchase timestamp, last_purchase timestamp",
    )
    rows = {r["order_year_month"]: r for r in periods.flag_period_quality(monthly).collect()}
    assert rows["2018-08"]["is_comparable_period"]
    assert rows["2018-09"]["is_low_volume_period"] and not rows["2018-09"]["is_partial_period"]
    assert rows["2018-10"]["is_partial_period"] and len(rows) == 3
    late_start = monthly.where("order_year_month > '2018-08'")
    rows = {r["order_year_month"]: r for r in periods.flag_period_quality(late_start).collect()}
    assert rows["2018-09"]["is_partial_period"]


def test_period_coverage_leaves_out_missing_months(spark):
    master = facts(spark, ["2018-01", "2018-02"]).unionAll(
        spark.createDataFrame([("x", "delivered", None, None)], facts(spark, ["2018-01"]).schema)
    )
    assert periods.period_coverage(master).count() == 2
    flags = {r[0]: r["is_partial_period"] for r in periods.edge_period_flags(master).collect()}
    assert flags == {"2018-01": True, "2018-02": True}


def test_month_texts(spark):
    df = spark.createDataFrame([("2018-06",), ("2018-06-30",), ("soon",), (None,)], "m string")
    keys = [r[0] for r in df.select(normalized_key("m")).collect()]
    assert keys == ["2018-06", "2018-06", None, None]
    labels = [r[0] for r in df.select(month_label("m")).collect()]
    assert labels == ["Jun 2018", "Jun 2018", None, None]


def test_untranslated_categories_must_be_shown(spark):
    items = spark.createDataFrame([("o1", "p1")], "order_id string, product_id string")
    base = spark.createDataFrame(
        [("o1", "delivered", dt(2018, 1, 1))],
        "order_id string, order_status string, order_purchase_timestamp timestamp",
    )
    products = spark.createDataFrame([("p1", "sem")], "product_id string, product_category_name string")
    words = spark.createDataFrame(
        [("a", "b")], "product_category_name string, product_category_name_english string"
    )
    shown = spark.createDataFrame([("untranslated__sem",)], "category_name_english string")
    ok = checks.untranslated_shown(items, base, products, words, shown).collect()
    lost = checks.untranslated_shown(items, base, products, words, shown.limit(0)).collect()
    assert [tuple(r) for r in ok] == [("untranslated__sem", True)]
    assert [tuple(r) for r in lost] == [("untranslated__sem", False)]
    assert orders.fulfilled(base).count() == 1
