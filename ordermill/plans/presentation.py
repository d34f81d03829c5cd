"""Result columns in a form that two engines write the same way."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIGITS = 6


def _shown(df: DataFrame, name: str, rounded: set[str]) -> Column:
    kind = df.schema[name].dataType.typeName()
    if kind in ("timestamp", "timestamp_ntz"):
        return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)
    if name in rounded:
        return F.round(F.col(name), DIGITS).alias(name)
    return F.col(name)


def show(df: DataFrame, columns: str | None = None, rounded: str = "") -> DataFrame:
    """The named columns (all by default), times as text, means of doubles rounded."""
    names = columns.split() if columns else df.columns
    return df.select(*[_shown(df, name, set(rounded.split())) for name in names])


def times(*names: str) -> str:
    """SQL twin of the time format above."""
    return ", ".join(f"strftime({n}, '%Y-%m-%d %H:%M:%S') AS {n}" for n in names)


def means(*names: str) -> str:
    """SQL twin of the rounding above."""
    return ", ".join(f"round({n}, {DIGITS}) AS {n}" for n in names)
