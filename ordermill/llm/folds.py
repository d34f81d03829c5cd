"""Folds of labelled rows and bounded, deterministic samples of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: str | Column, folds: int) -> Column:
    """crc32 of the id as text modulo ``folds``; null for a null id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string").cast("binary")) % folds


def draw(value: Column) -> Column:
    """A number from 0 to 1 that depends on the value alone."""
    return F.pmod(F.xxhash64(value.cast("string"), F.lit("draw")), F.lit(1 << 30)) / F.lit(float(1 << 30))


def stratified(rows: DataFrame, key: str, by: str, per_value: int) -> DataFrame:
    """About ``per_value`` rows for each value of ``by`` (all rows of rarer values).

    The share kept is taken from the counts per value, so no value's rows
    meet in one task. The result has at most a few more rows than
    ``per_value`` times the number of values. Rows with a null value are left out.
    """
    counts = {row[0]: row[1] for row in rows.where(F.col(by).isNotNull()).groupBy(by).count().collect()}
    if not counts:
        return rows.limit(0)
    share = F.coalesce(
        *[F.when(F.col(by) == value, F.lit(min(1.0, per_value / n))) for value, n in counts.items()]
    )
    return rows.where(F.col(by).isNotNull() & (draw(F.col(key)) < share))


def labelled_texts(
    documents: DataFrame, labels: DataFrame, label: str, per_value: int, max_chars: int
) -> tuple[list[str], list[int]]:
    """Texts and 0/1 labels of a bounded training sample, in a fixed order, on the driver.

    About ``per_value`` documents of either label, the first ``max_chars``
    characters of each. The sampled ids (two columns, at most ``per_value``
    and a few per label) are small by construction, hence the broadcast. A
    document with several labels counts as the larger one.
    """
    known = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("_label"))
    )
    sample = stratified(known, "doc_id", "_label", per_value)
    rows = (
        documents.select("doc_id", F.substring("text", 1, max_chars).alias("_text"))
        .where(F.col("_text").isNotNull())
        .join(F.broadcast(sample), "doc_id")
        .collect()
    )
    rows.sort(key=lambda row: (row["doc_id"], row["_text"]))
    return [row["_text"] for row in rows], [row["_label"] for row in rows]
