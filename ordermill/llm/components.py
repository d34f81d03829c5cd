"""Connected components over tables of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.sources.scratch import materialize

BROADCAST_ROWS = 100_000  # a table of more rows is never sent to the driver, however small its files are


def unsent(df: DataFrame, rows: int) -> DataFrame:
    """``df`` to be joined on its keys' own partitions if it may hold more than ``BROADCAST_ROWS`` rows.

    Spark sizes a stored table by its compressed files, and an exploded one
    like the table before: it would broadcast either, many times its estimate.
    """
    return df.hint("merge") if rows > BROADCAST_ROWS else df


def _stars(links: DataFrame, small: bool, rows: int) -> DataFrame:
    """Hang neighbours of a node on the least of them; ``small``: only the lesser ones, and the node.

    ``links``: node a > node b, distinct, ``rows`` at most. Both rounds keep
    the components and bring no more links than there were.
    """
    if small:
        directed = links.select(F.col("a").alias("node"), F.col("b").alias("other"))
    else:
        directed = links.select(F.col("a").alias("node"), F.col("b").alias("other")).unionAll(
            links.select(F.col("b").alias("node"), F.col("a").alias("other"))
        )
    least = directed.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("root"))
    hung = directed.join(unsent(least, rows), "node")
    if small:
        moved = hung.select(F.col("other").alias("a"), F.col("root").alias("b")).unionAll(
            least.select(F.col("node").alias("a"), F.col("root").alias("b"))
        )
    else:
        moved = hung.where("other > node").select(F.col("other").alias("a"), F.col("root").alias("b"))
    return moved.where("a <> b").distinct()


def components(links: DataFrame, label: str = "links") -> DataFrame:
    """``node``, ``component`` (the least node reachable) of every node that has a link.

    ``links``: two columns a, b of numbers, either way round, repeats and
    loops allowed; null ends are ignored. Each round is written to the shared
    folder, so lineage stays short and a lost executor costs one round. Rounds
    grow with the logarithm of the longest path. Rows of a node with many
    links are summed up before the shuffle; only the join that hangs them on
    their root meets all of them, and adaptive execution may split it.
    """
    current = materialize(
        links.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        label,
    )
    state = _state(current)
    while True:
        current = materialize(_stars(_stars(current, False, state[0]), True, state[0]), label)
        after = _state(current)
        if after == state:
            break
        state = after
    ends = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return ends.unionAll(roots)


def _state(links: DataFrame) -> tuple:
    """Number of links and their sum of hashes: equal when a round changed nothing."""
    row = links.agg(
        F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)).cast("decimal(38,0)"))
    ).first()
    return tuple(row)
