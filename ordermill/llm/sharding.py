"""Consistent placement of rows on shards by a permutation-filled lookup table.

Each shard orders the slots of a prime-sized table in its own way: an offset
and a step, both hashed from its name, visit every slot once. Shards take
turns; at its turn a shard claims the first slot of its order that is still
free. So shards hold equal shares of the table (one slot more or less), and
when a shard leaves, few slots change hands besides its own. A row's key is
hashed to a slot: placing it is one look into a broadcast table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHARDS = 64
SLOTS_PER_SHARD = 100


def table_size(shards: int, per_shard: int = SLOTS_PER_SHARD) -> int:
    """The least prime with at least ``per_shard`` slots for each shard."""
    size = max(2, shards * per_shard)
    while any(size % divisor == 0 for divisor in range(2, int(size**0.5) + 1)):
        size += 1
    return size


def key_hash(text: Column, salt: str = "") -> Column:
    """60 bits of MD5 as a number; any engine with MD5 gets the same."""
    salted = F.concat(F.lit(salt), text) if salt else text
    return F.conv(F.substring(F.md5(salted.cast("binary")), 1, 15), 16, 10).cast("long")


def shard_names(count: int) -> list[str]:
    return [f"shard-{number:05d}" for number in range(count)]


def lookup_table(spark: SparkSession, shards: list[str], size: int | None = None) -> DataFrame:
    """``slot``, ``shard`` (number in ``shards``): one row per slot, ``size`` rows in all.

    The claims are one fold over the turns: the state is the list of slots
    in the order they were claimed, and turn t belongs to shard t modulo
    their number. Its cost grows with the square of ``size`` and depends on
    no data: meant for up to some hundred shards.
    """
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names must be given and distinct")
    size = size or table_size(len(shards))
    if size < len(shards):
        raise ValueError("the table has fewer slots than there are shards")
    count = len(shards)
    names = spark.range(1).select(F.posexplode(F.array(*[F.lit(name) for name in shards])).alias("shard", "name"))
    ordered = names.select(
        "shard",
        F.pmod(key_hash(F.col("name"), "offset:"), F.lit(size)).alias("offset"),
        (F.pmod(key_hash(F.col("name"), "step:"), F.lit(size - 1)) + 1).alias("step"),
    ).select(
        "shard",
        F.transform(
            F.sequence(F.lit(0), F.lit(size - 1)),
            lambda turn: F.pmod(F.col("offset") + turn * F.col("step"), F.lit(size)).cast("int"),
        ).alias("order"),
    )
    orders = ordered.agg(F.transform(F.sort_array(F.collect_list(F.struct("shard", "order"))), lambda x: x["order"]).alias("orders"))
    claimed = F.aggregate(
        F.sequence(F.lit(0), F.lit(size - 1)),
        F.array().cast("array<int>"),
        lambda slots, turn: F.concat(
            slots, F.slice(F.array_except(F.get(F.col("orders"), turn % count), slots), 1, 1)
        ),
    )
    return orders.select(F.posexplode(claimed).alias("turn", "slot")).select(
        "slot", (F.col("turn") % count).alias("shard")
    )


def place(rows: DataFrame, keys: list[str], shards: list[str], size: int | None = None) -> DataFrame:
    """All columns of ``rows`` and ``slot``, ``shard``; nothing is shuffled.

    The key is the text of the ``keys`` columns, joined by a zero byte; a null
    counts as empty text. Equal keys go to one shard: where a key may hold a
    large part of the rows, add a second column to the keys that tells its
    rows apart. The table is broadcast: its size follows from the number of
    shards alone (some kilobytes). ``rows`` must not have the two new columns.
    """
    if {"slot", "shard"} & set(rows.columns):
        raise ValueError("the rows already have a column slot or shard")
    size = size or table_size(len(shards))
    key = F.concat_ws("\0", *[F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")) for name in keys])
    placed = rows.withColumn("slot", F.pmod(key_hash(key), F.lit(size)).cast("int"))
    table = lookup_table(rows.sparkSession, shards, size)
    return placed.join(F.broadcast(table), "slot").select(*[placed[name] for name in placed.columns], "shard")


def write_shards(placed: DataFrame, path: str, files_per_shard: int = 8) -> None:
    """Placed rows as one folder per shard, each written by ``files_per_shard`` tasks at most."""
    shards = placed.sparkSession.conf.get("spark.sql.shuffle.partitions")
    part = F.pmod(F.xxhash64(*[F.col(f"`{name}`") for name in placed.columns if name != "shard"]), F.lit(files_per_shard))
    placed.repartition(int(shards), "shard", part).write.partitionBy("shard").parquet(path)
