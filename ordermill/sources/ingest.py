"""Typing of raw tables and the ingestion metadata."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordermill.sources.contract import METADATA_PREFIX, RAW_TABLES, TIMESTAMP_FORMAT, RawTable
from ordermill.sources.readers import read_csv, source_path

NULL_MARK = "<NULL>"  # fixed values: how a row is written out before hashing
FIELD_MARK = "||"


def _typed(df: DataFrame, name: str, kind: str) -> Column:
    """The column as ``kind``; text that does not parse becomes NULL."""
    column = F.col(name)
    if kind == "timestamp":
        if df.schema[name].dataType.typeName() == "string":
            return F.try_to_timestamp(column, F.lit(TIMESTAMP_FORMAT))
        return column
    return column if kind == "string" else column.try_cast(kind)


def apply_types(df: DataFrame, table: RawTable) -> DataFrame:
    """Cast the columns that are present and add the derived ones."""
    casts = {
        name: _typed(df, name, kind)
        for name, kind in table.columns.items()
        if name in df.columns and kind != "string"
    }
    typed = df.withColumns(casts) if casts else df
    for name, expression in table.derived.items():
        typed = typed.withColumn(name, F.expr(expression))
    return typed


def ingest(df: DataFrame, name: str) -> DataFrame:
    """Typed form of the raw table ``name``."""
    return apply_types(df, RAW_TABLES[name])


def rejections(df: DataFrame, name: str, parsed: Mapping[str, Column] | None = None) -> Column:
    """Cells of a raw row that hold text which does not parse, as an array of (column, text, reason).

    ``parsed`` names the typed form of columns that are parsed already.
    """
    table, known = RAW_TABLES[name], parsed or {}
    cells = [
        F.when(
            F.col(column).isNotNull() & known.get(column, _typed(df, column, kind)).isNull(),
            F.struct(
                F.lit(column).alias("column_name"), F.col(column).cast("string").alias("text"),
                F.lit(f"no {kind}").alias("reason"),
            ),
        )
        for column, kind in table.columns.items()
        if column in df.columns and kind != "string"
    ]
    kind = "array<struct<column_name: string, text: string, reason: string>>"
    return F.array_compact(F.array(*cells)).cast(kind) if cells else F.array().cast(kind)


def with_rejections(df: DataFrame, name: str) -> DataFrame:
    """Typed form of the raw table, with the cells that were lost on the way in ``_rejected``."""
    table = RAW_TABLES[name]
    kinds = {column: kind for column, kind in table.columns.items() if column in df.columns and kind != "string"}
    both = df.withColumns({f"_parsed_{column}": _typed(df, column, kind) for column, kind in kinds.items()}) if kinds else df
    parsed = {column: F.col(f"_parsed_{column}") for column in kinds}  # each cell is parsed once
    typed = both.select(
        *[parsed[c].alias(c) if c in parsed else F.col(f"`{c}`") for c in df.columns],
        rejections(df, name, parsed).alias("_rejected"),
    )
    for column, expression in table.derived.items():
        typed = typed.withColumn(column, F.expr(expression))
    return typed


def ledger(stored: DataFrame, name: str) -> DataFrame:
    """One row per rejected cell of a stored bronze table; ``row_hash`` names the row it is missing from.

    Reads the two columns it needs, so raw files are parsed only once.
    """
    kept = stored.where(F.size("_rejected") > 0).select(F.col("_row_hash").alias("row_hash"), F.inline("_rejected"))
    return kept.select(F.lit(name).alias("table_name"), "column_name", "text", "reason", "row_hash")


def value_reconciliation(raw: DataFrame, stored: DataFrame, rejected: DataFrame, name: str) -> DataFrame:
    """Per typed column: values in the raw table against stored and rejected ones; PASS if none is lost."""
    columns = [column for column, kind in RAW_TABLES[name].columns.items() if kind != "string"]

    def counted(df: DataFrame, label: str) -> DataFrame:
        counts = df.agg(*[F.count(column).alias(column) for column in columns])
        return counts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias(label)) for c in columns])))

    if not columns:
        return stored.sparkSession.createDataFrame([], VALUES_SCHEMA)
    lost = rejected.groupBy("column_name").agg(F.count(F.lit(1)).alias("rejected_values"))
    both = counted(raw, "raw_values").join(counted(stored, "typed_values"), "column_name").join(lost, "column_name", "left")
    balanced = F.col("raw_values") == F.col("typed_values") + F.coalesce("rejected_values", F.lit(0))
    return both.select(
        F.lit(name).alias("table_name"), "column_name", "raw_values", "typed_values",
        F.coalesce("rejected_values", F.lit(0).cast("bigint")).alias("rejected_values"),
        F.when(balanced, "PASS").otherwise("FAIL").alias("status"),
    )


VALUES_SCHEMA = (
    "table_name string, column_name string, raw_values bigint, typed_values bigint, rejected_values bigint, status string"
)


def row_hash(columns: list[str]) -> Column:
    """md5 over all columns; a missing value differs from a missing column."""
    written = [F.coalesce(F.col(name).cast("string"), F.lit(NULL_MARK)) for name in columns]
    return F.md5(F.concat_ws(FIELD_MARK, *written))


def with_metadata(df: DataFrame, source: str, batch_id: str | None = None) -> DataFrame:
    """Stamp source, time, batch and row hash; one batch id for the whole table."""
    data = [name for name in df.columns if not name.startswith(METADATA_PREFIX)]
    return df.withColumns(
        {
            "_source": F.lit(source),
            "_ingested_at": F.current_timestamp(),
            "_batch_id": F.lit(batch_id or str(uuid.uuid4())),
            "_row_hash": row_hash(data),
        }
    )


def ingest_source(
    spark: SparkSession, sources: dict[str, str], name: str, batch_id: str | None = None, gather: bool = True
) -> DataFrame:
    """Read, type and stamp one configured raw source.

    ``gather``: rows come gathered by the column that the table is stored by;
    hash and stamps are added behind that shuffle, which they would only make
    wider. Else they come as they lie in the files, without a shuffle.
    """
    table = RAW_TABLES[name]
    raw = read_csv(spark, source_path(spark, sources, name), table.text_schema, table.multiline)
    typed = with_rejections(raw, name)
    gathered = typed.hint("rebalance", table.partition_by) if gather and table.partition_by else typed
    return with_metadata(gathered, name, batch_id)
