"""Customer profiles built from the one-row-per-order fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordermill.functions.labels import UNKNOWN
from ordermill.functions.numeric import money_sum, ratio

REFERENCE_DATE = "2018-10-17"  # fixed value: last day of the published data


def _spend_per_payment_type(master: DataFrame) -> DataFrame:
    """Mergeable facts per customer and payment type.

    The first grouping absorbs a customer with very many orders: after it a
    customer has at most one row per payment type. Rows of one order lie
    together before it, so that the order counts once: ``orders`` once for
    each type it has, ``new_orders`` once for the customer.
    """
    kind = F.col("primary_payment_type")
    together = Window.partitionBy("customer_unique_id", "order_id").orderBy(kind.asc_nulls_last())
    first = F.row_number().over(together) == 1
    known = F.col("order_id").isNotNull()
    marked = master.withColumns(
        {"_new": known & first, "_new_kind": known & (first | ~kind.eqNullSafe(F.lag(kind).over(together)))}
    )
    return marked.groupBy("customer_unique_id", "primary_payment_type").agg(
        F.count_if("_new_kind").alias("orders"),
        F.count_if("_new").alias("new_orders"),
        F.min("order_purchase_timestamp").alias("first_purchase"),
        F.max("order_purchase_timestamp").alias("last_purchase"),
        money_sum("order_revenue").alias("revenue"),
        F.count("order_revenue").alias("valued_orders"),
        F.sum("avg_review_score").alias("score_sum"),
        F.count("avg_review_score").alias("scored_orders"),
        F.sum("is_late").alias("late_orders"),
        F.count("is_late").alias("judged_orders"),
        money_sum("payment_total").alias("paid"),
        F.min("customer_state").alias("state"),
    )


def _preference_window() -> Window:
    return Window.partitionBy("customer_unique_id").orderBy(
        F.col("primary_payment_type").isNull().asc(),
        F.desc("orders"),
        F.desc("paid"),
        F.asc("primary_payment_type"),
    )


def preferred_payment(master: DataFrame) -> DataFrame:
    """Most frequent payment type; ties by paid value, then by the alphabet."""
    known = master.where(
        F.col("customer_unique_id").isNotNull() & F.col("primary_payment_type").isNotNull()
    )
    first = F.struct(-F.col("orders"), F.col("paid").isNull(), -F.col("paid"), "primary_payment_type")
    per_type = known.groupBy("customer_unique_id", "primary_payment_type").agg(
        F.count_distinct("order_id").alias("orders"), money_sum("payment_total").alias("paid")
    )
    return (
        per_type.groupBy("customer_unique_id")
        .agg(F.min_by("primary_payment_type", first).alias("preferred_payment"))
    )


def customer_profile(master: DataFrame, reference_date: str = REFERENCE_DATE) -> DataFrame:
    """One row per customer, with the preferred payment type taken on the way.

    An order with several rows counts once; its money counts in every row.
    """
    placed = _spend_per_payment_type(master).withColumn(
        "_place", F.row_number().over(_preference_window())
    )
    favourite = F.max(F.when(F.col("_place") == 1, F.col("primary_payment_type")))
    profile = placed.groupBy("customer_unique_id").agg(
        F.min("first_purchase").alias("first_purchase"),
        F.max("last_purchase").alias("last_purchase"),
        F.sum("new_orders").alias("total_orders"),
        money_sum("revenue").alias("total_revenue"),
        ratio(money_sum("revenue"), F.sum("valued_orders"), empty=None).alias("avg_order_value"),
        ratio(F.sum("score_sum"), F.sum("scored_orders"), empty=None).alias("avg_review_score"),
        ratio(F.sum("late_orders"), F.sum("judged_orders"), empty=None).alias("late_delivery_rate"),
        F.min("state").alias("customer_state"),
        favourite.alias("preferred_payment"),
    )
    anonymous = F.col("customer_unique_id").isNull()
    return profile.select(
        "customer_unique_id",
        "first_purchase",
        "last_purchase",
        "total_orders",
        "total_revenue",
        "avg_order_value",
        "avg_review_score",
        "late_delivery_rate",
        F.datediff(F.lit(reference_date).cast("date"), "last_purchase").alias("recency_days"),
        F.datediff("last_purchase", "first_purchase").alias("customer_age_days"),
        F.coalesce("customer_state", F.lit(UNKNOWN)).alias("customer_state"),
        F.coalesce(F.when(~anonymous, F.col("preferred_payment")), F.lit(UNKNOWN)).alias(
            "preferred_payment"
        ),
    )


def customer_profile_first_order(
    master: DataFrame, reference_date: str = REFERENCE_DATE
) -> DataFrame:
    """The variant that takes payment type and state from the earliest order.

    Orders of the same moment are told apart by ``order_id``.
    """
    bought = F.col("order_purchase_timestamp")
    moment = F.when(bought.isNotNull(), F.struct(bought, "order_id"))
    profile = master.groupBy("customer_unique_id").agg(
        F.min(bought).alias("first_purchase"),
        F.max(bought).alias("last_purchase"),
        F.count_distinct("order_id").alias("total_orders"),
        money_sum("order_revenue").alias("total_revenue"),
        ratio(money_sum("order_revenue"), F.count("order_revenue"), empty=None).alias(
            "avg_order_value"
        ),
        F.avg("avg_review_score").alias("avg_review_score"),
        F.avg("is_late").alias("late_delivery_rate"),
        F.min_by("primary_payment_type", moment).alias("preferred_payment"),
        F.min_by("customer_state", moment).alias("customer_state"),
    )
    aged = profile.withColumns(
        {
            "recency_days": F.datediff(F.lit(reference_date).cast("date"), "last_purchase"),
            "customer_age_days": F.datediff("last_purchase", "first_purchase"),
        }
    )
    frequency = ratio("total_orders", F.col("customer_age_days") + 1, empty=None) * 30
    return aged.withColumn("purchase_frequency_score", frequency)
