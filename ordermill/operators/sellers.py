"""Seller scorecards."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.functions.labels import (
    TIER_HIGH_ABOVE,
    TIER_MEDIUM_FROM,
    UNKNOWN,
    mask_identifier,
    revenue_tier,
)
from ordermill.functions.numeric import money_sum
from ordermill.operators.ranking import with_position
from ordermill.operators.skew import hot_keys, join_one


def seller_orders(items: DataFrame) -> DataFrame:
    """One row per seller and order, however many items the order has."""
    return items.select("seller_id", "order_id").dropDuplicates()


def _seller_totals(items: DataFrame, master: DataFrame, money: Mapping[str, Column]) -> DataFrame:
    """Money per seller next to the number, mean review and late share of its orders.

    Money is added up per seller before the shuffle; only the pairs of seller
    and order meet the orders, so each order counts once per seller.
    """
    paid = items.groupBy("seller_id").agg(*[money_sum(value).alias(name) for name, value in money.items()])
    facts = master.select("order_id", "avg_review_score", "is_late")
    pairs = join_one(
        seller_orders(items), facts, "order_id", spread_on="seller_id", hot=hot_keys(items, "order_id")
    )
    judged = pairs.groupBy(F.col("seller_id").alias("_seller")).agg(
        F.count("order_id").alias("total_orders"),
        F.avg("avg_review_score").alias("avg_review"),
        F.avg("is_late").alias("late_rate"),
    )
    both = paid.join(judged, F.col("seller_id").eqNullSafe(F.col("_seller")))
    return both.select("seller_id", "total_orders", *money, "avg_review", "late_rate")


def seller_performance(
    items: DataFrame,
    master: DataFrame,
    sellers: DataFrame,
    high_above: float = TIER_HIGH_ABOVE,
    medium_from: float = TIER_MEDIUM_FROM,
) -> DataFrame:
    """One row per seller; the tier looks at revenue including freight."""
    price, freight = F.col("price"), F.col("freight_value")
    money = {"total_product_revenue": price, "total_freight": freight, "total_revenue": price + freight}
    totals = _seller_totals(items, master, money)
    return totals.join(sellers.select("seller_id", "seller_state"), "seller_id", "left").withColumns(
        {
            "seller_state": F.coalesce("seller_state", F.lit(UNKNOWN)),
            "performance_tier": revenue_tier("total_revenue", high_above, medium_from),
        }
    )


def seller_performance_two_level(
    items: DataFrame,
    master: DataFrame,
    sellers: DataFrame,
    high_above: float = TIER_HIGH_ABOVE,
    medium_from: float = TIER_MEDIUM_FROM,
) -> DataFrame:
    """The shorter variant; an unlisted seller keeps a NULL state."""
    totals = _seller_totals(items, master, {"total_revenue": F.col("price") + F.col("freight_value")})
    return totals.join(sellers.select("seller_id", "seller_state"), "seller_id", "left").withColumn(
        "performance_tier", revenue_tier("total_revenue", high_above, medium_from)
    )


def seller_ranking(performance: DataFrame) -> DataFrame:
    """Sellers by value with their 1-based place and a shortened id.

    Sellers of equal value are placed by id.
    """
    placed = with_position(performance, "seller_rank", [F.desc("total_revenue"), F.asc("seller_id")])
    return placed.select(
        "seller_rank",
        mask_identifier("seller_id").alias("seller_id_short"),
        "seller_state",
        "total_orders",
        F.col("total_revenue").alias("seller_attributed_order_value"),
        "avg_review",
        "late_rate",
        "performance_tier",
    )


def sellers_where(
    ranking: DataFrame, state: str | None = None, tier: str | None = None
) -> DataFrame:
    """Ranking rows of one state and/or tier."""
    if state is not None:
        ranking = ranking.where(F.col("seller_state") == state)
    if tier is not None:
        ranking = ranking.where(F.col("performance_tier") == tier)
    return ranking


def top_seller_state(ranking: DataFrame) -> DataFrame:
    """The state with the largest summed value."""
    value = money_sum("seller_attributed_order_value")
    return (
        ranking.groupBy("seller_state")
        .agg(value.alias("seller_attributed_order_value"))
        .orderBy(F.desc("seller_attributed_order_value"), F.asc("seller_state"))
        .limit(1)
    )


def most_common_tier(ranking: DataFrame) -> DataFrame:
    """The most frequent tier; ties go to the alphabet."""
    return (
        ranking.groupBy("performance_tier")
        .agg(F.count(F.lit(1)).alias("sellers"))
        .orderBy(F.desc("sellers"), F.asc("performance_tier"))
        .limit(1)
    )
