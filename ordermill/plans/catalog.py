"""All registered queries by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ordermill.plans import (
    distinct_queries,
    forecast_queries,
    quality_queries,
    report_queries,
    storage_queries,
    table_queries,
)
from ordermill.plans.shop import Shop

_GROUPS = (
    table_queries.QUERIES,
    report_queries.QUERIES,
    storage_queries.QUERIES,
    quality_queries.QUERIES,
    forecast_queries.QUERIES,
    distinct_queries.QUERIES,
)


def _all() -> dict[str, tuple[Callable[[Shop], DataFrame], str | None]]:
    return {name: entry for group in _GROUPS for name, entry in group.items()}


_shops: dict[tuple[str, str], tuple[tuple, Shop]] = {}


def _version(spark: SparkSession, folder: str) -> tuple:
    """Names, sizes and times of what lies in a folder, on any file system Spark can read."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    listed = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(place)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in listed))


def shop_of(spark: SparkSession, folder: str) -> Shop:
    """One per application and folder, so that queries share the tables stored on the way; a new one when files changed."""
    key, version = (spark.sparkContext.applicationId, folder), _version(spark, folder)
    if key not in _shops or _shops[key][0] != version:
        _shops[key] = (version, Shop(spark, folder))
    return _shops[key][1]


def _bound(build: Callable[[Shop], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: build(shop_of(spark, folder))


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _bound(build) for name, (build, _) in _all().items()}


def sql_queries() -> dict[str, str]:
    return {name: text for name, (_, text) in _all().items() if text}
