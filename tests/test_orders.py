from __future__ import annotations

from datetime import datetime as dt

import pytest

from ordermill.functions.numeric import money_sum
from ordermill.operators import customers, orders, sellers

ORDERS = (
    "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp,"
    " order_approved_at timestamp, order_delivered_customer_date timestamp,"
    " order_estimated_delivery_date timestamp"
)
ITEMS = "order_id string, order_item_id int, product_id string, seller_id string, price double, freight_value double"
PAYMENTS = "order_id string, payment_sequential int, payment_type string, payment_value double"


def rows_by(df, key):
    return {row[key]: row.asDict() for row in df.collect()}


@pytest.fixture(scope="module")
def shop(spark):
    day = lambda d, h=0: dt(2018, 1, d, h)
    base = spark.createDataFrame(
        [
            ("o1", "c1", "delivered", day(1), None, day(4), day(5)),
            ("o2", "c1", "canceled", day(1), day(2), None, day(5)),
            ("o3", "c2", "delivered", day(1), day(1), day(5, 9), day(5)),
            ("o4", None, "shipped", None, None, day(9), None),
            ("o5", "c9", "canceled", day(2), None, day(9), day(5)),
        ],
        ORDERS,
    )
    items = spark.createDataFrame(
        [
            ("o1", 1, "p1", "s1", 10.0, 2.5),
            ("o1", 2, "p2", "s1", 30.0, 0.0),
            ("o3", 1, "p1", "s2", 0.0, 5.0),
            ("o3", 2, "p1", "s2", None, 5.0),
            ("o3", 3, "p1", "s2", 20.0, None),
        ],
        ITEMS,
    )
    payments = spark.createDataFrame(
        [
            ("o1", 1, "card", 30.0), ("o1", 2, "voucher", 20.0), ("o1", 3, "voucher", 20.0),
            ("o2", 2, "boleto", 5.0), ("o2", 1, "card", 5.0),
            ("o3", 1, "voucher", 7.0), ("o3", 1, "card", 7.0),
        ],
        PAYMENTS,
    )
    reviews = spark.createDataFrame(
        [("o1", 5), ("o1", 2), ("o2", None)], "order_id string, review_score int"
    )
    people = spark.createDataFrame(
        [("c1", "u1", "x", "SP"), ("c2", "u2", None, "RJ")],
        "customer_id string, customer_unique_id string, customer_city string, customer_state string",
    )
    return dict(orders=base, items=items, payments=payments, reviews=reviews, customers=people)


def build(shop):
    return orders.master_orders(
        orders.clean_orders(shop["orders"]),
        orders.clean_order_items(shop["items"]),
        shop["payments"],
        shop["reviews"],
        shop["customers"],
    )


def test_clean_orders_derives_delivery_columns(shop):
    seen = rows_by(orders.clean_orders(shop["orders"]), "order_id")
    assert [seen["o1"][c] for c in ("is_late", "delivery_delay_days", "delivery_days")] == [0, 0, 3]
    assert seen["o1"]["order_approved_at"] == dt(2018, 1, 1)
    assert [seen["o2"][c] for c in ("is_late", "delivery_delay_days", "delivery_days")] == [None] * 3
    assert seen["o2"]["is_canceled"] == 1 and seen["o1"]["is_canceled"] == 0
    assert seen["o1"]["order_year_month"] == "2018-01"


def test_late_by_time_of_day_has_no_delay_days(shop):
    seen = rows_by(orders.clean_orders(shop["orders"]), "order_id")
    assert (seen["o3"]["is_late"], seen["o3"]["delivery_delay_days"]) == (1, 0)


def test_only_delivered_orders_are_late_in_the_variant(shop):
    everyone = rows_by(orders.clean_orders(shop["orders"]), "order_id")
    delivered = rows_by(orders.clean_orders(shop["orders"], delivered_only=True), "order_id")
    assert everyone["o5"]["is_late"] == 1 and everyone["o5"]["delivery_delay_days"] == 4
    assert delivered["o5"]["is_late"] is None and delivered["o5"]["delivery_delay_days"] is None


def test_items_without_positive_price_are_dropped_and_counted(shop):
    assert orders.clean_order_items(shop["items"]).count() == 3
    counts = orders.dropped_item_count(shop["items"]).first()
    assert tuple(counts) == (5, 3, 2)
    first = orders.clean_order_items(shop["items"]).where("order_item_id = 1").first()
    assert first["total_item_value"] == 12.5 and first["freight_ratio"] == 0.2


def test_master_orders_keeps_one_row_per_order(shop):
    seen = rows_by(build(shop), "order_id")
    assert sorted(seen) == ["o1", "o2", "o3", "o4", "o5"]
    o1, o4 = seen["o1"], seen["o4"]
    assert (o1["order_revenue"], o1["freight_total"], o1["item_count"]) == (40.0, 2.5, 2)
    assert (o1["payment_total"], o1["revenue_per_item"]) == (70.0, 20.0)
    assert (o1["avg_review_score"], o1["customer_unique_id"]) == (3.5, "u1")
    assert (o4["order_revenue"], o4["item_count"], o4["payment_total"]) == (0.0, 0, 0.0)
    assert (o4["primary_payment_type"], o4["customer_state"]) == ("unknown", "unknown")
    assert o4["avg_review_score"] is None and o4["customer_unique_id"] is None
    assert seen["o3"]["customer_city"] == "unknown"


def test_primary_payment_rules(shop):
    by_sum = rows_by(orders.payments_by_type(shop["payments"]), "order_id")
    by_row = rows_by(orders.primary_payment_by_row(shop["payments"]), "order_id")
    # Two vouchers outweigh the card in sum, the card is the largest single payment.
    assert by_sum["o1"]["primary_payment_type"] == "voucher"
    assert by_row["o1"]["primary_payment_type"] == "card"
    # Equal value: the earlier sequence, then the alphabet.
    assert by_sum["o2"]["primary_payment_type"] == by_row["o2"]["primary_payment_type"] == "card"
    assert by_sum["o3"]["primary_payment_type"] == by_row["o3"]["primary_payment_type"] == "card"


def test_missing_review_is_zero_in_the_variant(shop):
    table = orders.master_orders_by_row(
        orders.clean_orders(shop["orders"], delivered_only=True),
        orders.clean_order_items(shop["items"]),
        shop["payments"], shop["reviews"], shop["customers"],
    )
    seen = rows_by(table, "order_id")
    assert seen["o4"]["avg_review_score"] == 0.0 and seen["o2"]["avg_review_score"] == 0.0
    assert seen["o1"]["primary_payment_type"] == "card"


def test_uniqueness_gate_raises(spark):
    twice = spark.createDataFrame([("a",), ("a",), (None,)], "order_id string")
    assert tuple(orders.key_uniqueness(twice, "order_id").first()) == (3, 2, False)
    with pytest.raises(ValueError, match="one row per order_id"):
        orders.require_unique(twice, "order_id", "orders")


def test_profile_prefers_the_most_frequent_payment(spark):
    facts = spark.createDataFrame(
        [
            ("o1", "u1", dt(2018, 1, 1), 10.0, None, 1, 10.0, "card", "SP"),
            ("o2", "u1", dt(2018, 1, 4), 20.0, 4.0, None, 20.0, "boleto", "RJ"),
            ("o3", "u1", dt(2018, 2, 1), 30.0, 5.0, 0, 30.0, "boleto", "SP"),
            ("o4", None, dt(2018, 2, 1), 5.0, 1.0, 0, 5.0, "card", "SP"),
        ],
        "order_id string, customer_unique_id string, order_purchase_timestamp timestamp,"
        " order_revenue double, avg_review_score double, is_late int, payment_total double,"
        " primary_payment_type string, customer_state string",
    )
    seen = rows_by(customers.customer_profile(facts), "customer_unique_id")
    u1 = seen["u1"]
    assert (u1["preferred_payment"], u1["total_orders"], u1["total_revenue"]) == ("boleto", 3, 60.0)
    assert (u1["avg_review_score"], u1["late_delivery_rate"], u1["customer_state"]) == (4.5, 0.5, "RJ")
    assert (u1["customer_age_days"], u1["recency_days"]) == (31, 258)
    assert seen[None]["preferred_payment"] == "unknown"
    assert customers.preferred_payment(facts).count() == 1
    first = rows_by(customers.customer_profile_first_order(facts), "customer_unique_id")["u1"]
    assert (first["preferred_payment"], first["customer_state"]) == ("card", "SP")


def test_seller_counts_each_order_once(shop, spark):
    people = spark.createDataFrame([("s1", "SP")], "seller_id string, seller_state string")
    items = orders.clean_order_items(shop["items"])
    seen = rows_by(sellers.seller_performance(items, build(shop), people), "seller_id")
    s1, s2 = seen["s1"], seen["s2"]
    assert (s1["total_orders"], s1["total_product_revenue"], s1["total_revenue"]) == (1, 40.0, 42.5)
    assert (s1["avg_review"], s1["late_rate"], s1["performance_tier"]) == (3.5, 0.0, "low")
    assert (s2["seller_state"], s2["total_freight"], s2["total_revenue"]) == ("unknown", None, None)


def test_seller_tiers_and_ranking(spark):
    table = spark.createDataFrame(
        [("a" * 16, "SP", 1, 10_000.0), ("b", "SP", 1, 10_000.5), ("c", "RJ", 1, 999.0), ("d", "RJ", 1, 999.0)],
        "seller_id string, seller_state string, total_orders long, total_revenue double",
    ).selectExpr("*", "1.0D AS avg_review", "0.0D AS late_rate", "'x' AS performance_tier")
    ranking = sellers.seller_ranking(table)
    assert [r["seller_id_short"] for r in ranking.orderBy("seller_rank").collect()] == [
        "b", "aaaaaaaa...aaaa", "c", "d",
    ]
    assert sellers.top_seller_state(ranking).first()["seller_state"] == "SP"
    assert sellers.sellers_where(ranking, state="RJ").count() == 2


def test_money_sums_do_not_depend_on_order(spark):
    from ordermill.functions.numeric import money_sum

    values = [0.1, 0.2, -0.3, 1e11, 1e-4, -1e11, None, 90_071_992.5473]
    for order in (values, values[::-1]):
        df = spark.createDataFrame([(v,) for v in order], "v double").repartition(3)
        assert df.agg(money_sum("v").alias("s")).first()["s"] == 90_071_992.5474
    empty = spark.createDataFrame([], "v double").agg(money_sum("v").alias("s")).first()
    assert empty["s"] is None


def test_totals_keep_all_decimals_and_odd_amounts(spark):
    rows = [("a", 0.000004), ("a", 0.000004), ("b", 0.1), ("b", 0.2), ("c", 1e15), ("c", 1.0), ("d", float("nan")), ("e", None), ("f", float("inf"))]
    df = spark.createDataFrame(rows, "k string, v double")
    total = {r["k"]: r["t"] for r in df.groupBy("k").agg(money_sum("v").alias("t")).collect()}
    assert total["a"] == 0.000008 and total["b"] == 0.3 and total["c"] == 1e15 + 1
    assert total["d"] != total["d"] and total["e"] is None and total["f"] == float("inf")
