"""Sinks: stored tables, catalog tables and report files."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


COMPRESSION = "zstd"  # stored tables hold hashes as text, which snappy leaves at full length


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` and an observation for ``rows_seen``: rows are counted while they are written."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def rows_seen(seen: Observation) -> int:
    """Rows of a table from ``counted`` after it was written.

    Where Spark found the table empty while it ran, it drops the observation with the rest of the plan.
    """
    row = seen._jo.getRow()
    return row.getLong(0) if row.length() else 0


def write_table(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    fmt: str = "parquet",
    gather: bool = True,
) -> DataFrame:
    """Replace the table at ``path``, schema included, and return a scan of it.

    Rows of a partitioned table are gathered by its partition columns, so each
    folder gets few files; the rebalance splits a folder that holds many rows
    over several tasks. Without ``gather`` each task writes its own rows to
    the folders they belong to: no shuffle, a file per task and folder.
    """
    keys = partition_by or []
    rows = df.hint("rebalance", *keys) if keys and gather else df
    writer = rows.write.format(fmt).mode("overwrite").option("overwriteSchema", True)
    writer = writer.option("compression", COMPRESSION)
    (writer.partitionBy(*keys) if keys else writer).save(path)
    reader = df.sparkSession.read.format(fmt)
    # A given schema saves the inference and keeps the types of partition
    # columns; a Delta table brings its own.
    return (reader if fmt == "delta" else reader.schema(df.schema)).load(path)


def ensure_schema(
    spark: SparkSession, schema: str, comment: str | None = None, location: str | None = None
) -> None:
    quoted = lambda text: "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
    described = f" COMMENT {quoted(comment)}" if comment else ""
    located = f" LOCATION {quoted(location)}" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}{described}{located}")


def list_tables(spark: SparkSession, schema: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {schema}")


def write_catalog_table(
    df: DataFrame, name: str, partition_by: list[str] | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Replace a managed table and return it."""
    writer = df.write.format(fmt).mode("overwrite").option("overwriteSchema", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def write_csv_report(df: DataFrame, path: str) -> None:
    """Headed CSV files in the order of the table: one for a small report, more where it takes more tasks."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """Headed CSV files, one per task; quotes are doubled."""
    df.write.mode("overwrite").options(header=True, quote='"', escape='"', compression=compression).csv(path)


def write_json_report(df: DataFrame, path: str) -> None:
    """JSON lines, as ``write_csv_report``."""
    df.write.mode("overwrite").json(path)
