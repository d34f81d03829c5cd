from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(parallelism: int = 8) -> SparkSession:
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("ordermill-tests")
        .config("spark.sql.shuffle.partitions", parallelism)
        .config("spark.default.parallelism", parallelism)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    return spark
