"""Joins that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_MEANS = 2  # a key is hot when it holds more rows than so many mean partitions
SUB_KEYS = 4  # for each mean partition that a hot key holds


def partition_count(df: DataFrame) -> int:
    """Shuffle partitions of the session: what a join deals its rows to."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(df: DataFrame, key: str, partitions: int | None = None) -> Column:
    """Keys that would overfill a partition, as a map from key to its number of sub-keys.

    A key is hot when it holds more than ``HOT_MEANS`` times the mean share of
    ``partitions`` (by default those of a shuffle), and gets ``SUB_KEYS`` sub-keys
    for each mean share it holds, so that they fall evenly on the partitions. A one-pass frequent-items sketch over the key column
    alone finds them, so it needs no shuffle of the keys. The sketch only
    decides which keys are spread; the join result does not depend on it.
    """
    parts = partitions or partition_count(df)
    most = max(2, -(-parts // HOT_MEANS))
    tracked = F.call_function("approx_top_k", F.col(key), F.lit(most), F.lit(min(most * 64, 1_000_000)))
    rows = F.count(F.lit(1))
    frequent = F.filter(tracked, lambda entry: entry["item"].isNotNull() & (entry["count"] * parts > rows * HOT_MEANS))
    spread = F.transform(
        frequent,
        lambda entry: F.struct(
            entry["item"].alias("key"), F.ceil(entry["count"] * parts * SUB_KEYS / rows).cast("int").alias("value")
        ),
    )
    return df.agg(F.map_from_entries(spread).alias("hot")).scalar()


def gathered(
    rows: DataFrame,
    key: str,
    combined: Callable[[DataFrame], DataFrame],
    hot: Column | None = None,
    parts: int | None = None,
) -> DataFrame:
    """``rows`` dealt by ``key``, so that groups and joins by it need no shuffle of their own.

    Nothing is grouped before the shuffle, where nearly every row has a key of its own and a
    hash table would hold a whole input split. Only rows of hot keys, and those without a key,
    are ``combined`` first (to few rows per key, of the same columns): no key brings more than
    a fair share of rows to its task. With ``parts`` the partitions stay that many: adaptive
    execution merges others up to a size at which groups of wide rows may not fit a task.
    """
    hot = hot_keys(rows, key) if hot is None else hot
    often = F.col(key).isNull() | F.element_at(hot, F.col(key)).isNotNull()
    return rows.where(~often).unionByName(combined(rows.where(often))).repartition(*([parts] if parts else []), key)


def join_one(
    fact: DataFrame,
    one: DataFrame,
    key: str,
    spread_on: str,
    how: str = "left",
    hot: Column | None = None,
) -> DataFrame:
    """Equi-join ``fact`` with a table holding one row per ``key``.

    Fact rows of a hot key are spread over its sub-keys by the hash of
    ``spread_on``; the matching row of ``one`` is repeated once per sub-key.
    All other keys keep a single sub-key, so ``one`` grows by at most about
    ``SUB_KEYS`` rows for each partition. Rows without a key match nothing
    and are spread as well.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type: {how}")
    hot = hot_keys(fact, key) if hot is None else hot
    parts = F.coalesce(F.element_at(hot, F.col(key)), F.lit(1))
    salts = F.when(F.col(key).isNull(), F.lit(partition_count(fact))).otherwise(parts)
    spread = F.pmod(F.xxhash64(spread_on), salts).cast("int")
    return (
        fact.withColumn("_salt", spread)
        .join(one.withColumn("_salt", F.explode(F.sequence(F.lit(0), parts - 1))), [key, "_salt"], how)
        .drop("_salt")
    )
