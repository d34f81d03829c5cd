"""Coverage of months and whether a month can be compared with others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.functions.months import month_start
from ordermill.functions.numeric import as_column
from ordermill.operators.orders import fulfilled

MIN_PERIOD_ORDERS = 100  # fixed value: smaller months are not compared
FLAGS = ["is_partial_period", "is_low_volume_period", "is_comparable_period"]


def period_coverage(master: DataFrame) -> DataFrame:
    """Orders and first/last purchase per month; orders without a month are left out."""
    return (
        master.where(F.col("order_year_month").isNotNull())
        .groupBy("order_year_month")
        .agg(
            F.count_distinct("order_id").alias("order_count"),
            F.min("order_purchase_timestamp").alias("first_purchase"),
            F.max("order_purchase_timestamp").alias("last_purchase"),
        )
    )


def _first_and_last() -> tuple[Column, Column]:
    """The first and last month, over the few rows of a table with one row per month."""
    months = Window.partitionBy()
    return F.min("order_year_month").over(months), F.max("order_year_month").over(months)


def flag_period_quality(
    monthly: DataFrame, order_col: str = "order_count", min_orders: int = MIN_PERIOD_ORDERS
) -> DataFrame:
    """Mark partial, low-volume and comparable months; no month is dropped.

    The first month is partial when its first purchase comes after day 1, the
    last month when its last purchase comes before the month's last day.
    """
    key = F.col("order_year_month")
    first, last = _first_and_last()
    opens, closes = key == F.col("_first"), key == F.col("_last")
    partial = F.lit(False)
    if "first_purchase" in monthly.columns:
        partial = partial | (opens & (F.dayofmonth("first_purchase") > 1))
    if "last_purchase" in monthly.columns:
        month_end = F.dayofmonth(F.last_day(month_start(key)))
        partial = partial | (closes & (F.dayofmonth("last_purchase") < month_end))
    volume = F.coalesce(as_column(order_col), F.lit(0))
    return (
        monthly.withColumns({"_first": first, "_last": last})
        .withColumns(
            {
                order_col: volume,
                "is_partial_period": F.coalesce(partial, F.lit(False)),
                "is_low_volume_period": volume < min_orders,
            }
        )
        .withColumn(
            "is_comparable_period",
            ~(F.col("is_partial_period") | F.col("is_low_volume_period")),
        )
        .drop("_first", "_last")
    )


def edge_period_flags(master: DataFrame, min_orders: int = MIN_PERIOD_ORDERS) -> DataFrame:
    """The variant on fulfilled orders: the first and the last month are always partial."""
    coverage = (
        fulfilled(master)
        .groupBy("order_year_month")
        .agg(F.count_distinct("order_id").alias("order_count"))
    )
    first, last = _first_and_last()
    key = F.col("order_year_month")
    return coverage.select(
        "order_year_month",
        "order_count",
        ((key == first) | (key == last)).alias("is_partial_period"),
        (F.col("order_count") < min_orders).alias("is_low_volume_period"),
    )
