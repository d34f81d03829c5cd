"""Exact counts of distinct orders that can be merged: sets of numbered orders as bitmaps.

Orders get dense numbers in the order of the grouping columns, so the orders
of one group lie side by side and fill few bitmaps of 4 KB. A set of orders is
a table of (group, bucket, bitmap); joining two sets is an OR per bucket, so
counts of any coarser grouping come from the stored sets without the orders,
and an order that occurs in several groups still counts once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.sources.scratch import materialize

BUCKET_BITS = 32_768  # orders per bitmap


def first_of_order(*keys: str, order_by: list[Column] | None = None) -> Column:
    """True on one row of every known order within ``keys``: the first by ``order_by``."""
    window = Window.partitionBy(*keys, "order_id").orderBy(*(order_by or [F.lit(1)]))
    return F.col("order_id").isNotNull() & (F.row_number().over(window) == 1)


def numbered_orders(master: DataFrame, keys: list[str]) -> DataFrame:
    """``order_id``, ``number`` of every known order, from 1 on, orders of like ``keys`` side by side.

    The numbers are stored, so that a lost task does not deal others; tasks
    leave gaps of whole buckets between them.
    """
    placed = master.where(F.col("order_id").isNotNull()).groupBy("order_id").agg(*[F.min(key).alias(key) for key in keys])
    dealt = placed.repartitionByRange(*keys, "order_id").sortWithinPartitions(*keys, "order_id")
    return materialize(dealt.select("order_id", (F.monotonically_increasing_id() + 1).alias("number")), "numbers")


def order_sets(master: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, ``bucket``, ``orders``: the distinct orders of every group as bitmaps."""
    numbers = numbered_orders(master, keys)
    rows = master.where(F.col("order_id").isNotNull()).select(*keys, "order_id").join(numbers, "order_id")
    return rows.groupBy(*keys, F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("orders")
    )


def merged_sets(sets: DataFrame, keys: list[str]) -> DataFrame:
    """The sets of a coarser grouping."""
    return sets.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("orders").alias("orders"))


def order_counts(sets: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, ``order_count``: distinct orders of the given grouping of the sets."""
    return merged_sets(sets, keys).groupBy(*keys).agg(F.sum(F.bitmap_count("orders")).alias("order_count"))
