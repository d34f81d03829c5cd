"""Cleaned orders and items, and the one-row-per-order fact table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions.labels import UNKNOWN
from ordermill.functions.months import month_key
from ordermill.functions.numeric import MONEY_BEGUN, flag, from_ticks, in_ticks, money_begun, money_sum, ratio, ticks
from ordermill.operators.skew import gathered, join_one

DELIVERED = "delivered"
CANCELED = "canceled"


def fulfilled(orders: DataFrame) -> DataFrame:
    """Delivered orders with a known purchase time."""
    return orders.where(
        (F.col("order_status") == DELIVERED) & F.col("order_purchase_timestamp").isNotNull()
    )


def clean_orders(orders: DataFrame, delivered_only: bool = False) -> DataFrame:
    """Fill the approval time and derive calendar and delivery columns.

    Lateness is unknown (NULL) unless both the delivery and the promised time
    are known; with ``delivered_only`` also unless the status is delivered.
    It compares times of day, the delay counts calendar days.
    """
    bought = F.col("order_purchase_timestamp")
    arrived = F.col("order_delivered_customer_date")
    promised = F.col("order_estimated_delivery_date")

    judged = arrived.isNotNull() & promised.isNotNull()
    if delivered_only:
        judged = judged & (F.col("order_status") == DELIVERED)
    overdue = flag(arrived > promised)
    overdue_days = F.when(arrived > promised, F.datediff(arrived, promised)).otherwise(0)

    return orders.withColumns(
        {
            "order_approved_at": F.coalesce("order_approved_at", bought),
            "is_canceled": flag(F.col("order_status") == CANCELED),
            "order_year": F.year(bought),
            "order_month": F.month(bought),
            "order_year_month": month_key(bought),
            "delivery_days": F.datediff(arrived, bought),
            "is_late": F.when(judged, overdue),
            "delivery_delay_days": F.when(judged, overdue_days),
        }
    )


def sellable(items: DataFrame) -> DataFrame:
    """Items with a positive price; a missing price is dropped too."""
    return items.where(F.col("price") > 0)


def clean_order_items(items: DataFrame) -> DataFrame:
    """Sellable items with their total value and the freight part of it."""
    value = F.col("price") + F.col("freight_value")
    share = F.when(value > 0, F.col("freight_value") / value).otherwise(0.0)
    return sellable(items).withColumns({"total_item_value": value, "freight_ratio": share})


def dropped_item_count(items: DataFrame) -> DataFrame:
    """Rows read, kept and dropped by the price rule, in one pass."""
    kept = F.count_if(F.col("price") > 0)
    read = F.count(F.lit(1))
    return items.agg(
        read.alias("input_rows"),
        kept.alias("output_rows"),
        (read - kept).alias("filtered_rows"),
    )


def key_uniqueness(df: DataFrame, key: str) -> DataFrame:
    """Row count against distinct key count, from one grouping."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("_copies"))
    rows = F.coalesce(F.sum("_copies"), F.lit(0))
    distinct = F.count(F.lit(1))
    return sizes.agg(
        rows.alias("row_count"),
        distinct.alias("distinct_keys"),
        (rows == distinct).alias("is_unique"),
    )


def require_unique(df: DataFrame, key: str, table: str) -> DataFrame:
    """``df`` itself, after checking that every key occurs once."""
    seen = key_uniqueness(df, key).first()
    if not seen["is_unique"]:
        raise ValueError(
            f"{table} must hold one row per {key}: "
            f"{seen['row_count']} rows, {seen['distinct_keys']} keys"
        )
    return df


def item_totals(items: DataFrame, count_lines: bool = False) -> DataFrame:
    """Money and item count per order; ``count_lines`` skips items without a number."""
    counted = flag(F.col("order_item_id").isNotNull()) if count_lines else F.lit(1)
    money = ["price", "freight_value"]
    kinds = {name: items.schema[name].dataType for name in money}
    rows = items.select(
        "order_id",
        *money,
        counted.cast("bigint").alias("lines"),
        *[F.lit(None).cast(MONEY_BEGUN).alias(f"{name}_begun") for name in money],
    )

    def combined(often: DataFrame) -> DataFrame:
        begun = [money_begun(name).alias(f"{name}_begun") for name in money]
        return often.groupBy("order_id").agg(F.sum("lines").alias("lines"), *begun).withColumns(
            {name: F.lit(None).cast(kind) for name, kind in kinds.items()}
        )

    return gathered(rows, "order_id", combined).groupBy("order_id").agg(
        money_sum("price", "price_begun").alias("order_revenue"),
        money_sum("freight_value", "freight_value_begun").alias("freight_total"),
        F.sum("lines").alias("item_count"),
    )


def payment_types(payments: DataFrame) -> DataFrame:
    """Paid total and first sequence number per order and payment type.

    The total also comes in its two parts, whole ten-thousandths and the
    amounts that are none, so that totals over types stay exact.
    """
    paid = F.col("payment_value")
    exact = in_ticks(paid)
    single = payments.select(
        "order_id",
        "payment_type",
        F.when(exact, ticks(F.when(exact, paid))).alias("type_ticks"),
        F.when(~exact, paid.cast("double")).alias("type_rest"),
        F.when(paid.isNotNull(), 1).otherwise(0).cast("bigint").alias("type_rows"),
        F.col("payment_sequential").alias("first_sequence"),
    )
    return _summed_types(gathered(single, "order_id", _summed_types)).withColumns(
        {
            "type_rest": F.coalesce("type_rest", F.lit(0.0)),
            "type_value": F.when(
                F.col("type_rows") > 0,
                from_ticks(F.coalesce("type_ticks", F.lit(0))) + F.coalesce("type_rest", F.lit(0.0)),
            ),
        }
    )


def _summed_types(rows: DataFrame) -> DataFrame:
    return rows.groupBy("order_id", "payment_type").agg(
        F.sum("type_ticks").alias("type_ticks"),
        F.sum("type_rest").alias("type_rest"),
        F.sum("type_rows").alias("type_rows"),
        F.min("first_sequence").alias("first_sequence"),
    )


def payment_totals(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(
        money_sum("payment_value").alias("payment_total")
    )


def payments_by_type(payments: DataFrame) -> DataFrame:
    """Paid total per order and the type with the largest *summed* value.

    Ties go to the earlier sequence number, then to the alphabet. Both results
    come from the same per-type rows in one grouping, so payments are shuffled once
    and are not read at all where a later step needs neither.
    """
    value = F.col("type_value")
    largest = F.struct(value.isNull(), ~F.isnan(value), -value, "first_sequence", "payment_type")
    total = from_ticks(F.coalesce(F.sum("type_ticks"), F.lit(0))) + F.sum("type_rest")
    return payment_types(payments).groupBy("order_id").agg(
        F.when(F.sum("type_rows") > 0, total).alias("payment_total"),
        F.min_by("payment_type", largest).alias("primary_payment_type"),
    )


def _largest_payment() -> Column:
    """Type of the largest single payment; the earlier one and then the alphabet on ties."""
    paid = F.col("payment_value").cast("double")
    first = F.struct(paid.isNull(), -paid, "payment_sequential", "payment_type")
    return F.min_by("payment_type", first).alias("primary_payment_type")


def primary_payment_by_row(payments: DataFrame) -> DataFrame:
    """Type of the largest *single* payment of each order; rows are combined before the shuffle."""
    return payments.groupBy("order_id").agg(_largest_payment())


def payments_by_row(payments: DataFrame) -> DataFrame:
    """Paid total and type of the largest single payment, from one pass over the payments."""
    return payments.groupBy("order_id").agg(
        money_sum("payment_value").alias("payment_total"), _largest_payment()
    )


def review_means(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("order_id").agg(
        F.avg(F.col("review_score").cast("double")).alias("avg_review_score")
    )


def with_item_totals(orders: DataFrame, items: DataFrame, count_lines: bool = False) -> DataFrame:
    """Add item money and counts; an order without items gets zeros."""
    totals = item_totals(items, count_lines)
    filled = {
        "order_revenue": F.coalesce("order_revenue", F.lit(0.0)),
        "freight_total": F.coalesce("freight_total", F.lit(0.0)),
        "item_count": F.coalesce("item_count", F.lit(0).cast("bigint")),
    }
    return (
        orders.join(totals, "order_id", "left")
        .withColumns(filled)
        .withColumn("revenue_per_item", ratio("order_revenue", "item_count"))
    )


def with_payments(orders: DataFrame, per_order: DataFrame) -> DataFrame:
    return orders.join(per_order, "order_id", "left").withColumns(
        {
            "payment_total": F.coalesce("payment_total", F.lit(0.0)),
            "primary_payment_type": F.coalesce("primary_payment_type", F.lit(UNKNOWN)),
        }
    )


def with_reviews(
    orders: DataFrame, reviews: DataFrame, missing_score: float | None = None
) -> DataFrame:
    joined = orders.join(review_means(reviews), "order_id", "left")
    if missing_score is None:
        return joined
    return joined.withColumn(
        "avg_review_score", F.coalesce("avg_review_score", F.lit(float(missing_score)))
    )


def with_customers(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Add the customer columns; one customer may own a large part of the orders.

    Best done on plain orders: finding such customers scans the given table.
    """
    wanted = customers.select("customer_id", "customer_unique_id", "customer_city", "customer_state")
    return join_one(orders, wanted, "customer_id", spread_on="order_id").withColumns(
        {
            "customer_city": F.coalesce("customer_city", F.lit(UNKNOWN)),
            "customer_state": F.coalesce("customer_state", F.lit(UNKNOWN)),
        }
    )


def master_orders(
    orders: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
    customers: DataFrame,
) -> DataFrame:
    """One row per order: cleaned order + item, payment, review and customer facts.

    Every detail table is brought to one row per order before it is joined, so
    no join can multiply orders. An order without reviews keeps a NULL score.
    """
    facts = with_customers(orders, customers)
    facts = with_item_totals(facts, items)
    facts = with_payments(facts, payments_by_type(payments))
    return with_reviews(facts, reviews)


def master_orders_by_row(
    orders: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
    customers: DataFrame,
) -> DataFrame:
    """The variant that ranks single payments and scores missing reviews as 0."""
    facts = with_customers(orders, customers)
    facts = with_item_totals(facts, items, count_lines=True)
    facts = with_payments(facts, payments_by_row(payments))
    return with_reviews(facts, reviews, missing_score=0.0)
