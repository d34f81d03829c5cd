from __future__ import annotations

from datetime import datetime as dt

import pytest
from pyspark.sql import functions as F

from ordermill.functions.labels import mask_identifier, revenue_tier
from ordermill.functions.numeric import non_negative, ratio
from ordermill.operators import marts, revenue


def test_ratio_never_divides_by_nothing(spark):
    df = spark.createDataFrame([(10.0, 0.0), (10.0, None), (None, 2.0), (9.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(ratio("a", "b")).collect()] == [0.0, 0.0, 0.0, 4.5]
    assert [r[0] for r in df.select(ratio("a", "b", empty=None)).collect()] == [None, None, None, 4.5]
    assert [r[0] for r in df.select(non_negative(F.col("b") - 1)).collect()] == [0.0, 0.0, 1.0, 1.0]


def test_labels(spark):
    df = spark.createDataFrame([("1234567890abcdef", 10_000.01), ("123456789012", 1_000.0), (None, None)], "i string, r double")
    rows = df.select(mask_identifier("i"), revenue_tier("r")).collect()
    assert [tuple(r) for r in rows] == [("12345678...cdef", "high"), ("123456789012", "medium"), (None, "low")]


@pytest.fixture
def master(spark):
    rows = [
        ("o1", "delivered", dt(2018, 1, 1), 100.0, 5.0, 1, 3, "SP", "card"),
        ("o2", "delivered", dt(2018, 1, 9), 60.0, 5.0, 0, 1, "SP", "boleto"),
        ("o3", "canceled", dt(2018, 1, 9), 30.0, 0.0, 1, 9, "RJ", "card"),
        ("o4", "delivered", None, 10.0, 0.0, None, None, None, None),
    ]
    schema = (
        "order_id string, order_status string, order_purchase_timestamp timestamp, order_revenue double,"
        " freight_total double, is_late int, delivery_days int, customer_state string, primary_payment_type string"
    )
    return spark.createDataFrame(rows, schema).selectExpr(
        "*",
        "year(order_purchase_timestamp) AS order_year",
        "month(order_purchase_timestamp) AS order_month",
        "date_format(order_purchase_timestamp, 'yyyy-MM') AS order_year_month",
        "CASE WHEN is_late = 1 THEN 2 WHEN is_late = 0 THEN 0 END AS delivery_delay_days",
        "CASE WHEN is_late IS NOT NULL THEN timestamp'2018-02-01' END AS order_delivered_customer_date",
        "timestamp'2018-02-01' AS order_estimated_delivery_date",
    )


def test_late_rate_counts_judged_deliveries_only(spark, master):
    assert master.agg(marts.late_delivery_rate()).first()[0] == 0.5
    assert master.limit(0).agg(marts.late_delivery_rate()).first()[0] == 0.0


def test_overview(master):
    row = marts.overview_kpis(master).first()
    assert (row["total_orders"], row["item_merchandise_value_ex_freight"], row["freight_value"]) == (4, 200.0, 10.0)
    assert row["avg_item_merchandise_value_per_order"] == 50.0
    assert (row["first_order_month"], row["last_order_month"]) == ("2018-01", "2018-01")


def test_marts_leave_out_missing_keys(spark, master):
    bi = revenue.bi_revenue(master)
    assert bi.count() == 4
    coverage = spark.createDataFrame(
        [("2018-01", False, True, False)],
        "order_year_month string, is_partial_period boolean, is_low_volume_period boolean, is_comparable_period boolean",
    )
    monthly = marts.monthly_revenue(bi, coverage).collect()
    assert [(r["order_year_month"], r["order_count"], r["item_revenue_ex_freight"]) for r in monthly] == [
        ("2018-01", 3, 190.0)
    ]
    states = marts.state_revenue(bi).collect()
    assert [r["customer_state"] for r in states] == ["SP", "RJ"]
    assert states[0]["avg_item_revenue_per_order"] == 80.0
    assert marts.top_states(marts.state_revenue(bi), 1).first()["customer_state"] == "SP"
    mix = {r["primary_payment_type"]: r["order_share"] for r in marts.payment_mix(bi).collect()}
    assert mix == {"card": 2 / 3, "boleto": 1 / 3}
    delivery = marts.delivery_performance(master, coverage, min_delivered=2).first()
    assert (delivery["delivered_order_count"], delivery["late_delivered_order_count"]) == (2, 1)
    assert delivery["late_delivery_rate_display"] == 0.5
    hidden = marts.delivery_performance(master, coverage, min_delivered=3)
    assert hidden.first()["late_delivery_rate_display"] is None
    assert marts.delivery_trend(hidden).count() == 0
    assert marts.comparable_months(marts.monthly_revenue(bi, coverage)).count() == 0


def test_delivered_revenue_has_no_rate_without_deliveries(master):
    rows = {r["customer_state"]: r for r in revenue.bi_revenue_delivered(master).where("primary_payment_type = 'card'").collect()}
    assert rows["SP"]["late_delivery_rate"] == 1.0 and rows["RJ"]["late_delivery_rate"] is None
    assert rows["RJ"]["avg_item_value_per_order"] == 30.0


def test_counts_and_choices(spark, master):
    counts = marts.layer_row_counts({"silver": {"master": master}, "gold": {"none": master.limit(0)}})
    assert [tuple(r) for r in counts.collect()] == [("silver", "master", 4), ("gold", "none", 0)]
    assert [r[0] for r in marts.distinct_values(master, "customer_state").collect()] == ["RJ", "SP"]


def test_changed_input_is_read_anew(spark, folder):
    from ordermill.plans.catalog import shop_of

    spark.range(3).write.parquet(f"{folder}/orders.parquet")
    first = shop_of(spark, folder)
    assert shop_of(spark, folder) is first and first.table("orders").count() == 3
    spark.range(5).write.mode("overwrite").parquet(f"{folder}/orders.parquet")
    again = shop_of(spark, folder)
    assert again is not first and again.table("orders").count() == 5
