"""Revenue by month, state and payment type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.functions.numeric import money_sum, ratio
from ordermill.operators.orders import DELIVERED

GRAIN = [
    "order_year",
    "order_month",
    "order_year_month",
    "customer_state",
    "primary_payment_type",
]


def bi_revenue(master: DataFrame) -> DataFrame:
    """Orders, revenue and late rate per month, state and primary payment type."""
    return master.groupBy(*GRAIN).agg(
        F.count("order_id").alias("total_orders"),
        money_sum("order_revenue").alias("total_revenue"),
        ratio(money_sum("order_revenue"), F.count("order_revenue"), empty=None).alias(
            "avg_order_value"
        ),
        F.avg("is_late").alias("late_delivery_rate"),
    )


def bi_revenue_delivered(master: DataFrame) -> DataFrame:
    """The variant whose late rate looks at delivered orders with both dates only.

    An order with several rows counts once. Without a delivered order the rate is NULL.
    """
    valid = (
        (F.col("order_status") == DELIVERED)
        & F.col("order_delivered_customer_date").isNotNull()
        & F.col("order_estimated_delivery_date").isNotNull()
    )
    value = "item_merchandise_value_ex_freight"
    return (
        master.groupBy(*GRAIN)
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            money_sum("order_revenue").alias(value),
            F.count_if(valid).alias("delivered_order_count"),
            F.count_if(valid & (F.col("is_late") == 1)).alias("late_delivery_count"),
        )
        .withColumns(
            {
                "avg_item_value_per_order": ratio(value, "total_orders"),
                "late_delivery_rate": ratio(
                    "late_delivery_count", "delivered_order_count", empty=None
                ),
            }
        )
    )
