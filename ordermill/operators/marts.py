"""Report tables for a dashboard."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.functions.numeric import money_sum, ratio
from ordermill.operators.orders import DELIVERED
from ordermill.operators.periods import FLAGS

# Fixed value: months with fewer delivered orders show no late rate.
MIN_DELIVERED_ORDERS = 100
VALUE = "item_merchandise_value_ex_freight"


def _judged_delivery() -> Column:
    return (F.col("order_status") == DELIVERED) & F.col("is_late").isNotNull()


def _late_delivery() -> Column:
    return (F.col("order_status") == DELIVERED) & (F.col("is_late") == 1)


def late_delivery_rate() -> Column:
    """Late share of the delivered orders whose lateness is known; 0 if there are none."""
    return ratio(F.count_if(_late_delivery()), F.count_if(_judged_delivery()))


def _or_zero(total: Column) -> Column:
    return F.coalesce(total, F.lit(0.0))


def overview_kpis(master: DataFrame) -> DataFrame:
    """One row of headline figures; an order with several rows counts once."""
    figures = master.agg(
        F.count_distinct("order_id").alias("total_orders"),
        _or_zero(money_sum("order_revenue")).alias(VALUE),
        _or_zero(money_sum("freight_total")).alias("freight_value"),
        late_delivery_rate().alias("late_delivery_rate"),
        F.min("order_year_month").alias("first_order_month"),
        F.max("order_year_month").alias("last_order_month"),
    )
    average = ratio(VALUE, "total_orders")
    return figures.withColumns(
        {
            "item_revenue_ex_freight": F.col(VALUE),
            "avg_item_merchandise_value_per_order": average,
            "avg_item_revenue_per_order": average,
        }
    )


def _revenue_by(bi: DataFrame, key: str) -> DataFrame:
    """Orders and value per key, rolled up from the revenue table; NULL keys are left out."""
    return (
        bi.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.sum("total_orders").alias("order_count"),
            _or_zero(money_sum("total_revenue")).alias(VALUE),
        )
        .withColumn("item_revenue_ex_freight", F.col(VALUE))
    )


def _with_average(revenue: DataFrame) -> DataFrame:
    average = ratio(VALUE, "order_count")
    return revenue.withColumns(
        {
            "avg_item_merchandise_value_per_order": average,
            "avg_item_revenue_per_order": average,
        }
    )


def monthly_revenue(bi: DataFrame, coverage: DataFrame) -> DataFrame:
    """Revenue per month next to the month's quality flags."""
    flags = coverage.select("order_year_month", *FLAGS)
    return (
        _with_average(_revenue_by(bi, "order_year_month"))
        .join(flags, "order_year_month", "left")
        .orderBy("order_year_month")
    )


def comparable_months(monthly: DataFrame) -> DataFrame:
    return monthly.where("is_comparable_period")


def state_revenue(bi: DataFrame) -> DataFrame:
    """Revenue per customer state, largest first."""
    return _with_average(_revenue_by(bi, "customer_state")).orderBy(
        F.desc(VALUE), F.asc("customer_state")
    )


def top_states(states: DataFrame, n: int = 15) -> DataFrame:
    return states.orderBy(F.desc(VALUE), F.asc("customer_state")).limit(n)


def payment_mix(bi: DataFrame) -> DataFrame:
    """Orders and value per primary payment type with the share of all orders."""
    mix = _revenue_by(bi, "primary_payment_type")
    everything = F.sum("order_count").over(Window.partitionBy())  # one row per payment type
    return mix.withColumn("order_share", F.col("order_count") / everything).orderBy(
        F.desc("order_count"), F.asc("primary_payment_type")
    )


def delivery_performance(
    master: DataFrame, coverage: DataFrame, min_delivered: int = MIN_DELIVERED_ORDERS
) -> DataFrame:
    """Delivery times and late rate per month; the shown rate needs enough deliveries."""
    small = F.col("delivered_order_count") < min_delivered
    return (
        master.where(F.col("order_year_month").isNotNull())
        .groupBy("order_year_month")
        .agg(
            F.count_distinct("order_id").alias("order_count"),
            F.avg("delivery_days").alias("avg_delivery_days"),
            F.avg("delivery_delay_days").alias("avg_delivery_delay_days"),
            F.count_if(_judged_delivery()).alias("delivered_order_count"),
            F.count_if(_late_delivery()).alias("late_delivered_order_count"),
            late_delivery_rate().alias("late_delivery_rate"),
        )
        .join(coverage.select("order_year_month", *FLAGS), "order_year_month", "left")
        .withColumns(
            {
                "is_low_delivered_volume_period": small,
                "late_delivery_rate_display": F.when(~small, F.col("late_delivery_rate")),
            }
        )
        .orderBy("order_year_month")
    )


def delivery_trend(delivery: DataFrame) -> DataFrame:
    """Months whose late rate is shown."""
    return delivery.where(
        ~F.col("is_low_delivered_volume_period") & F.col("late_delivery_rate_display").isNotNull()
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The non-NULL values of a column in order, as choices for a filter."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def row_counts(tables: Mapping[str, DataFrame], name: str = "table_name") -> DataFrame:
    """One row per table with its number of rows."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(table).alias(name), "row_count")
        for table, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def layer_row_counts(layers: Mapping[str, Mapping[str, DataFrame]]) -> DataFrame:
    """Row counts of all tables of all layers."""
    parts = [
        row_counts(tables).withColumn("layer", F.lit(layer)) for layer, tables in layers.items()
    ]
    return reduce(DataFrame.unionAll, parts).select("layer", "table_name", "row_count")
