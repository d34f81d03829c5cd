from __future__ import annotations

import hashlib
from collections import Counter

import pytest

from ordermill.llm import sharding


def brute_table(names: list[str], size: int) -> list[int]:
    def number(text: str) -> int:
        return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)

    owner, cursor = [-1] * size, [0] * len(names)
    for turn in range(size):
        shard = turn % len(names)
        offset, step = number("offset:" + names[shard]) % size, number("step:" + names[shard]) % (size - 1) + 1
        while owner[(offset + cursor[shard] * step) % size] >= 0:
            cursor[shard] += 1
        owner[(offset + cursor[shard] * step) % size] = shard
    return owner


@pytest.mark.parametrize(("shards", "size"), [(1, 2), (5, 101), (7, 7), (13, 211)])
def test_table_equals_turn_by_turn_fill(spark, shards, size):
    names = sharding.shard_names(shards)
    found = {row["slot"]: row["shard"] for row in sharding.lookup_table(spark, names, size).collect()}
    assert [found[slot] for slot in range(size)] == brute_table(names, size)


def test_shares_are_even_and_few_slots_move(spark):
    names = sharding.shard_names(8)
    before, after = brute_table(names, 809), brute_table(names[:-1], 809)
    shares = Counter(before)
    assert max(shares.values()) - min(shares.values()) <= 1
    moved = sum(a != b for a, b in zip(before, after) if a != 7)
    assert moved < 0.25 * 809


def test_rows_keep_columns_and_equal_keys_meet(spark, documents):
    names = sharding.shard_names(5)
    placed = sharding.place(documents, ["doc_id"], names)
    rows = placed.collect()
    assert placed.columns == [*documents.columns, "slot", "shard"]
    assert len(rows) == documents.count()
    assert len({(row["doc_id"], row["shard"]) for row in rows}) == len({row["doc_id"] for row in rows})
    wider = sharding.place(documents, ["doc_id", "text"], names).where("doc_id = 3").count()
    assert wider == documents.where("doc_id = 3").count()


def test_empty_table_and_clashes(spark, nothing):
    assert sharding.place(nothing, ["doc_id"], ["a", "b"]).count() == 0
    with pytest.raises(ValueError):
        sharding.place(nothing.withColumnRenamed("lang", "shard"), ["doc_id"], ["a"])
    with pytest.raises(ValueError):
        sharding.lookup_table(spark, ["a", "a"])


def test_written_folders(spark, documents, folder):
    placed = sharding.place(documents.select("doc_id", "text"), ["doc_id"], sharding.shard_names(3))
    sharding.write_shards(placed, f"{folder}/shards")
    again = spark.read.parquet(f"{folder}/shards")
    assert sorted(map(str, again.select(*placed.columns).collect())) == sorted(map(str, placed.collect()))
