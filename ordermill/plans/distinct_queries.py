"""Registered queries over facts in which orders occur more than once.

Every tenth order has a second row, every twentieth a third one with another
payment type. Orders count once, amounts in every row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.operators import churn, customers, distinct, marts, periods, revenue
from ordermill.plans.presentation import means, show, times
from ordermill.plans.shop import CTES, REFERENCE_DATE, Shop, sql
from ordermill.sources.scratch import materialize

_CUBE = ["order_year_month", "customer_state", "primary_payment_type", "order_status"]
_LEVELS = {
    "all": [],
    "month": ["order_year_month"],
    "state": ["customer_state"],
    "payment": ["primary_payment_type"],
    "month and state": ["order_year_month", "customer_state"],
    "status and payment": ["order_status", "primary_payment_type"],
}


def with_repeats(orders: DataFrame) -> DataFrame:
    """The orders with their repeats, made row by row: ``orders`` is computed once, and only in the columns in use."""
    copies = F.when(F.col("order_id") % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    paid = "primary_payment_type" in orders.columns
    if paid:
        copies = F.when(F.col("order_id") % 20 == 0, F.array(F.lit(0), F.lit(1), F.lit(2))).otherwise(copies)
    result = orders.withColumn("_copy", F.explode(copies))
    if paid:
        other = F.when(F.col("_copy") == 2, F.concat(F.lit("other "), "primary_payment_type"))
        result = result.withColumn("primary_payment_type", F.when(F.col("_copy") < 2, F.col("primary_payment_type")).otherwise(other))
    return result.drop("_copy")


def _repeated_sql(select: str, base: str, *names: str) -> str:
    """``sql`` with the repeats of ``base`` in its place."""
    repeats = "SELECT * FROM single_rows UNION ALL SELECT * FROM single_rows WHERE order_id % 10 = 0"
    if base == "master":
        repeats += (
            " UNION ALL SELECT * REPLACE (concat('other ', primary_payment_type) AS primary_payment_type)"
            " FROM single_rows WHERE order_id % 20 = 0"
        )
    return sql(select, *names, instead={"single_rows": CTES[base], base: ("single_rows", repeats)})


def _facts(shop: Shop) -> DataFrame:
    return with_repeats(shop.facts)


def _rollup(shop: Shop) -> DataFrame:
    """Distinct orders of several groupings, all from one stored table of sets."""
    rows = materialize(_facts(shop).select("order_id", *_CUBE), "cube")  # read twice
    sets = materialize(distinct.order_sets(rows, _CUBE), "sets")

    def level(name: str, keys: list[str]) -> DataFrame:
        return distinct.order_counts(sets, keys).select(
            F.lit(name).alias("level"),
            *[(F.col(key) if key in keys else F.lit(None).cast("string")).alias(key) for key in _CUBE],
            "order_count",
        )

    return reduce(DataFrame.unionAll, [level(name, keys) for name, keys in _LEVELS.items()])


def _rollup_sql() -> str:
    def level(name: str, keys: list[str]) -> str:
        columns = ", ".join(key if key in keys else f"CAST(NULL AS VARCHAR) AS {key}" for key in _CUBE)
        grouped = f" GROUP BY {', '.join(keys)}" if keys else ""
        return f"SELECT '{name}' AS level, {columns}, count(DISTINCT order_id) AS order_count FROM master{grouped}"

    return " UNION ALL ".join(level(name, keys) for name, keys in _LEVELS.items())


_PROFILE = (
    f"SELECT customer_unique_id, {times('first_purchase', 'last_purchase')}, total_orders, total_revenue, avg_order_value,"
    f" {means('avg_review_score', 'late_delivery_rate')}, recency_days, customer_age_days, customer_state, preferred_payment FROM profile"
)
_DELIVERED = """SELECT order_year_month, customer_state, primary_payment_type, count(DISTINCT order_id) AS total_orders,
    count(*) FILTER (WHERE order_status = 'delivered' AND is_late IS NOT NULL) AS delivered_order_count FROM master
    GROUP BY order_year, order_month, order_year_month, customer_state, primary_payment_type"""

QUERIES = {
    "distinct_orders_rollup": (_rollup, _repeated_sql(_rollup_sql(), "master", "master")),
    "customer_profile_repeated": (
        lambda shop: show(
            customers.customer_profile(_facts(shop), REFERENCE_DATE), rounded="avg_review_score late_delivery_rate"
        ),
        _repeated_sql(_PROFILE, "master", "profile"),
    ),
    "first_order_profile_repeated": (
        lambda shop: customers.customer_profile_first_order(_facts(shop)).select("customer_unique_id", "total_orders"),
        _repeated_sql("SELECT customer_unique_id, count(DISTINCT order_id) AS total_orders FROM master GROUP BY 1", "master", "master"),
    ),
    "preferred_payment_repeated": (
        lambda shop: customers.preferred_payment(_facts(shop)),
        _repeated_sql("SELECT * FROM preferred", "master", "preferred"),
    ),
    "churn_repeated": (
        lambda shop: churn.churn_features(with_repeats(shop.stored_eligible_orders), shop.reviews).select(
            "snapshot_date", "customer_unique_id", "total_orders", "total_revenue", "is_churned"
        ),
        _repeated_sql(
            "SELECT snapshot_date, customer_unique_id, total_orders, total_revenue, is_churned FROM churn", "eligible", "churn"
        ),
    ),
    "bi_delivered_repeated": (
        lambda shop: revenue.bi_revenue_delivered(_facts(shop)).select(
            "order_year_month", "customer_state", "primary_payment_type", "total_orders", "delivered_order_count"
        ),
        _repeated_sql(_DELIVERED, "master", "master"),
    ),
    "coverage_repeated": (
        lambda shop: periods.period_coverage(with_repeats(shop.clean_orders)).select("order_year_month", "order_count"),
        _repeated_sql("SELECT order_year_month, order_count FROM coverage", "c_orders", "coverage"),
    ),
    "delivery_repeated": (
        lambda shop: marts.delivery_performance(with_repeats(shop.clean_orders), shop.coverage).select(
            "order_year_month", "order_count", "delivered_order_count"
        ),
        _repeated_sql("SELECT order_year_month, order_count, delivered_order_count FROM delivery", "c_orders", "delivery"),
    ),
    "overview_repeated": (
        lambda shop: marts.overview_kpis(_facts(shop)).select("total_orders", "item_merchandise_value_ex_freight"),
        _repeated_sql(
            "SELECT count(DISTINCT order_id) AS total_orders, CAST(sum(CAST(order_revenue AS DECIMAL(18, 4))) AS DOUBLE)"
            " AS item_merchandise_value_ex_freight FROM master",
            "master", "master",
        ),
    ),
}
