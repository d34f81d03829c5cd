"""Positions, n-tiles and percent-rank scores over a whole table.

A window without a partition key would put every row in one task. Here the
rows are range-sorted over all tasks, numbered inside each task and written
once; the only global step adds up one row count per task.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.functions.numeric import flag
from ordermill.sources.scratch import materialize

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row number below bit 33


def _sorted_slices(df: DataFrame, order: list[Column]) -> DataFrame:
    """``df`` sorted, with the slice each row landed in and its place there.

    Written out because slice bounds come from sampling: all later uses must
    see the same slices, also after a lost executor.
    """
    numbered = df.orderBy(*order).withColumns(
        {"_id": F.monotonically_increasing_id(), "_task": F.spark_partition_id().cast("bigint")}
    )
    own = F.col("_id") - F.shiftleft(F.col("_task"), _LOCAL_BITS)
    full = F.raise_error(F.lit("a slice holds more rows than it can number: sort into more partitions"))
    placed = numbered.select(
        *df.columns,
        F.col("_task").alias("_slice"),
        F.when(own < (1 << _LOCAL_BITS), own).otherwise(full.cast("bigint")).alias("_local"),
    )
    return materialize(placed, "sorted")


def _slice_starts(slices: DataFrame) -> DataFrame:
    """Rows before each slice; one row per task of the sort."""
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = slices.groupBy("_slice").agg(F.count(F.lit(1)).alias("_rows"))
    return sizes.select(
        "_slice", "_rows", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )


def with_position(df: DataFrame, name: str, order: list[Column]) -> DataFrame:
    """Add the 1-based place of each row in ``order``, which must be a total order."""
    slices = _sorted_slices(df, order)
    starts = F.broadcast(_slice_starts(slices).select("_slice", "_start"))
    place = (F.col("_start") + F.col("_local") + 1).alias(name)
    return slices.join(starts, "_slice").select(*df.columns, place)


def ascending(column: str) -> Column:
    """Sort key of ``column ASC``: missing values come first."""
    return _sort_key(F.col(column), missing=-1)


def descending(column: str) -> Column:
    """Sort key of ``column DESC``: missing values come last."""
    return _sort_key(-F.col(column), missing=1)


def _sort_key(value: Column, missing: int) -> Column:
    """Measures of any numeric type in one column: the double puts them in order, and
    the decimal tells apart whole numbers and decimals that share a double."""
    absent = F.when(value.isNull(), missing).otherwise(0)
    inexact = F.typeof(value).isin("double", "float")
    exact = F.when(inexact, F.lit(None)).otherwise(value.try_cast("decimal(38,10)"))
    return F.struct(
        absent.alias("absent"),
        F.coalesce(value.cast("double"), F.lit(0.0)).alias("value"),
        F.coalesce(exact, F.lit(0).cast("decimal(38,10)")).alias("exact"),
    )


def _cut_rows(
    df: DataFrame,
    keys: Mapping[str, Column],
    tie_break: str,
    place_of: Callable[[Column, int], Column],
    parts: int,
) -> DataFrame:
    """The rows at which each measure changes score: ``parts - 1`` per measure.

    All measures are sorted by the same job: one narrow row per measure and
    table row, ordered by measure, key and tie-break. Every measure has the
    same number of rows ``n``, so its places follow from its number.
    ``place_of(n, cut)`` is the 1-based place of a cut within its measure.
    """
    measures = list(keys)
    tall = df.select(
        F.col(tie_break).alias("tie"),
        F.posexplode(F.array(*[keys[m] for m in measures])).alias("measure", "key"),
    )
    slices = _sorted_slices(tall, [F.asc("measure"), F.asc("key"), F.asc("tie")])
    starts = _slice_starts(slices)
    total = starts.agg((F.sum("_rows") / len(measures)).cast("bigint").alias("n")).scalar()
    n = F.col("_n")
    cuts = [
        F.struct(
            F.lit(measure).alias("_measure"),
            F.lit(cut).alias("cut"),
            F.when(place_of(n, cut) >= 1, measure * n + place_of(n, cut)).alias("place"),
        )
        for measure in range(len(measures))
        for cut in range(1, parts)
    ]
    local = F.col("place") - F.col("_start") - 1
    # One row per cut: the slice and the place in it where its row is found.
    located = (
        starts.withColumn("_n", total)
        .select("_slice", "_start", "_rows", F.inline(F.array(*cuts)))
        .where((local >= 0) & (local < F.col("_rows")))
        .select("cut", "_slice", local.alias("_local"))
    )
    return slices.join(F.broadcast(located), ["_slice", "_local"]).select(
        "measure", "cut", "key", "tie"
    )


def _cut_values(rows: DataFrame, measures: int, parts: int, *fields: str) -> Column:
    """All cut rows as one struct value, usable in a column expression."""
    value = F.struct(*fields)
    picked = [
        F.max(F.when((F.col("measure") == m) & (F.col("cut") == c), value)).alias(_cut_name(m, c))
        for m in range(measures)
        for c in range(1, parts)
    ]
    row = rows.agg(*picked)
    return row.select(F.struct(*row.columns)).scalar()


def _cut_name(measure: int, cut: int) -> str:
    return f"m{measure}c{cut}"


def _with_scores(
    df: DataFrame, cuts: Column, rows: list[tuple[str, Column]], parts: int
) -> DataFrame:
    """Add 1 + the number of cuts of its measure that a row lies beyond."""
    scores = {}
    for measure, (name, value) in enumerate(rows):
        score = F.lit(1)
        for cut in range(1, parts):
            score = score + flag(value > F.col("_cuts")[_cut_name(measure, cut)])
        scores[name] = score
    return df.withColumn("_cuts", cuts).withColumns(scores).drop("_cuts")


def ntile_scores(
    df: DataFrame, keys: Mapping[str, Column], tie_break: str, parts: int = 5
) -> DataFrame:
    """``ntile(parts)`` of every row for each measure, ordered by key then tie-break.

    ``tie_break`` must be unique. Only the last row of each tile is looked up,
    then tiles follow from comparing each row with those few rows, so the
    table itself is neither sorted nor joined.
    """

    def tile_end(n: Column, cut: int) -> Column:
        return cut * F.floor(n / parts) + F.least(F.lit(cut).cast("bigint"), n % parts)

    rows = _cut_rows(df, keys, tie_break, tile_end, parts)
    cuts = _cut_values(rows, len(keys), parts, "key", "tie")
    own = [(name, F.struct(key, F.col(tie_break))) for name, key in keys.items()]
    return _with_scores(df, cuts, own, parts)


def percent_rank_scores(
    df: DataFrame, keys: Mapping[str, Column], tie_break: str, parts: int = 5
) -> DataFrame:
    """``least(parts, floor(percent_rank * parts) + 1)``; equal keys share a score.

    A row reaches score ``k + 1`` when at least ``ceil(k (n - 1) / parts)`` rows
    have a smaller key, that is when its key lies beyond the key at that place.
    """

    def place(n: Column, cut: int) -> Column:
        return F.ceil(cut * (n - 1) / parts)

    rows = _cut_rows(df, keys, tie_break, place, parts)
    cuts = _cut_values(rows, len(keys), parts, "key")
    own = [(name, F.struct(key)) for name, key in keys.items()]
    return _with_scores(df, cuts, own, parts)
