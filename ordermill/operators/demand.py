"""Monthly category demand, its gap-free form, and forecast features."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ordermill.functions.labels import category_label
from ordermill.functions.months import is_last_quarter, month_key, month_start, shift_key
from ordermill.functions.numeric import money_sum, ratio
from ordermill.operators.orders import fulfilled
from ordermill.operators.periods import edge_period_flags
from ordermill.operators.skew import hot_keys, join_one

MEASURES = ["monthly_units", "monthly_revenue", "avg_price"]


def _series(month: str) -> WindowSpec:
    return Window.partitionBy("category_name_english").orderBy(month)


def labelled_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    """The category label of every product; a category shared by very many products, or none, is spread."""
    joined = join_one(
        products.select("product_id", "product_category_name"),
        translation.select("product_category_name", "product_category_name_english"),
        "product_category_name",
        spread_on="product_id",
    )
    label = category_label("product_category_name", "product_category_name_english")
    return joined.select("product_id", label.alias("category_name_english"))


def category_sales(
    items: DataFrame, orders: DataFrame, products: DataFrame, translation: DataFrame
) -> DataFrame:
    """Units, revenue and average price per category and purchase month.

    Only fulfilled orders count. Sold items reach the lookup of their product as they
    are, a best-selling product spread over sub-keys: few share product and month, so
    sums per product would group nearly all rows for nothing. The side with one row
    per key is the smaller one and is hashed, so the items are never sorted.
    """
    months = fulfilled(orders).select("order_id", "order_year_month").hint("shuffle_hash")
    sold = join_one(
        items.select("order_id", "order_item_id", "product_id", "price"),
        months,
        "order_id",
        spread_on="product_id",
        how="inner",
    )
    unknown = category_label(F.lit(None).cast("string"), F.lit(None).cast("string"))
    labelled = join_one(
        sold,
        labelled_products(products, translation).hint("shuffle_hash"),
        "product_id",
        spread_on="order_id",
        hot=hot_keys(items, "product_id"),
    ).withColumn("category_name_english", F.coalesce("category_name_english", unknown))
    return labelled.groupBy("category_name_english", "order_year_month").agg(
        F.count("order_item_id").alias("monthly_units"),
        money_sum("price").alias("monthly_revenue"),
        ratio(money_sum("price"), F.count("price"), empty=None).alias("avg_price"),
    )


def with_growth(demand: DataFrame) -> DataFrame:
    """Add the previous observed month and the growth over it in percent."""
    change = F.col("monthly_units") - F.col("prev_month")
    growth = F.when(F.col("prev_month") > 0, change / F.col("prev_month") * 100).otherwise(0.0)
    previous = F.lag("monthly_units").over(_series("order_year_month"))
    return demand.withColumn("prev_month", previous).withColumn("mom_growth", growth)


def product_demand(
    items: DataFrame, orders: DataFrame, products: DataFrame, translation: DataFrame
) -> DataFrame:
    return with_growth(category_sales(items, orders, products, translation))


def demand_history(demand: DataFrame) -> DataFrame:
    return demand.select("category_name_english", "order_year_month", *MEASURES)


def demand_features(demand: DataFrame) -> DataFrame:
    """Features for the next month from the observed rows of each category.

    Lags count *rows*: where a category has no row for a month, ``lag_2`` and
    later lags, and the target, come from the neighbouring observed month.
    """
    series = _series("order_year_month")
    units = F.col("monthly_units")
    month_number = F.month(month_start("forecast_month"))
    return (
        demand_history(demand)
        .withColumns(
            {
                "forecast_month": shift_key("order_year_month", 1),
                "target_units": F.lead(units).over(series),
                "lag_1": units,
                "lag_2": F.lag(units, 1).over(series),
                "lag_4": F.lag(units, 3).over(series),
                "rolling_mean_3": F.avg(units).over(series.rowsBetween(-2, Window.currentRow)),
            }
        )
        .withColumns({"month_num": month_number, "is_q4": is_last_quarter(month_number)})
        .where(F.col("lag_4").isNotNull() & F.col("target_units").isNotNull())
        .withColumnRenamed("order_year_month", "feature_cutoff_month")
    )


def demand_spine(demand: DataFrame) -> DataFrame:
    """Every month of every category, from its first month to the last of all."""
    observed = demand.where(F.col("category_name_english").isNotNull()).withColumn(
        "forecast_month", month_start("order_year_month")
    )
    last = observed.agg(F.max("forecast_month").alias("last")).scalar()
    first = observed.groupBy("category_name_english").agg(F.min("forecast_month").alias("first"))
    months = F.sequence(F.col("first"), last, F.expr("INTERVAL 1 MONTH"))
    return first.select("category_name_english", F.explode(months).alias("forecast_month"))


def monthly_demand(demand: DataFrame) -> DataFrame:
    """The gap-free monthly series; a month without sales has zeros."""
    observed = demand.select(
        "category_name_english",
        month_start("order_year_month").alias("forecast_month"),
        F.col("monthly_units").cast("double").alias("target_units"),
        F.col("monthly_revenue").cast("double").alias("monthly_revenue"),
        F.col("avg_price").cast("double").alias("avg_price"),
    )
    zero_filled = {
        name: F.coalesce(name, F.lit(0.0)) for name in ("target_units", "monthly_revenue", "avg_price")
    }
    return (
        demand_spine(demand)
        .join(observed, ["category_name_english", "forecast_month"], "left")
        .withColumns(zero_filled)
        .withColumn("order_year_month", month_key("forecast_month"))
    )


def demand_features_calendar(
    demand: DataFrame, master: DataFrame, min_orders: int = 100
) -> DataFrame:
    """Features whose lags are *calendar* months, with the lagged month as proof.

    Rows also tell whether the predicted month is comparable; a month without
    any fulfilled order counts as partial and as low volume.
    """
    series = _series("forecast_month")
    flags = edge_period_flags(master, min_orders)
    lagged = {}
    for n in (1, 2, 4):
        lagged[f"lag_{n}"] = F.lag("target_units", n).over(series)
        lagged[f"lag_{n}_source_month"] = F.lag("forecast_month", n).over(series)
    lagged["rolling_mean_3"] = F.avg("target_units").over(series.rowsBetween(-3, -1))
    known = {
        "order_count": F.coalesce("order_count", F.lit(0).cast("bigint")),
        "is_partial_period": F.coalesce("is_partial_period", F.lit(True)),
        "is_low_volume_period": F.coalesce("is_low_volume_period", F.lit(True)),
    }
    complete = F.col("lag_1").isNotNull()
    for name in ("lag_2", "lag_4", "rolling_mean_3"):
        complete = complete & F.col(name).isNotNull()
    return (
        monthly_demand(demand)
        .withColumns(lagged)
        .where(complete)
        .join(flags, "order_year_month", "left")
        .withColumns(known)
        .select(
            "category_name_english",
            "forecast_month",
            "order_year_month",
            "target_units",
            "lag_1",
            "lag_2",
            "lag_4",
            "rolling_mean_3",
            "lag_1_source_month",
            "lag_2_source_month",
            "lag_4_source_month",
            F.month("forecast_month").alias("month_num"),
            is_last_quarter(F.month("forecast_month")).alias("is_q4"),
            "order_count",
            "is_partial_period",
            "is_low_volume_period",
            (~(F.col("is_partial_period") | F.col("is_low_volume_period"))).alias(
                "target_period_comparable"
            ),
        )
    )


def comparable_summary(features: DataFrame) -> DataFrame:
    return features.groupBy("target_period_comparable").agg(
        F.count(F.lit(1)).alias("feature_rows"),
        F.countDistinct("forecast_month").alias("forecast_months"),
        F.countDistinct("category_name_english").alias("categories"),
    )


def demand_cutoff_month(orders: DataFrame) -> DataFrame:
    """The last complete month: the one before the month of the latest purchase."""
    latest = F.max("order_purchase_timestamp")
    return orders.agg(month_key(F.add_months(latest, -1)).alias("cutoff_month"))
