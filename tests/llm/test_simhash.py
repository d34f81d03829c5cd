from __future__ import annotations

import random
import re
import sys
from itertools import combinations

import numpy as np
import pytest
import xxhash

from ordermill.llm import simhash
from ordermill.llm.components import components


def brute_print(text: str | None) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(run.encode(), 42) for run in runs]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_groups(prints: list[int], radius: int) -> list[int]:
    root = list(range(len(prints)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= radius:
            low, high = sorted((top(i), top(j)))
            root[high] = low
    return [top(i) for i in range(len(prints))]


@pytest.mark.parametrize("level", [0, 1, 2])
def test_masks_cover_all_pairs_within_the_radius(level):
    masks = simhash.covering_masks(4, level)
    chooser = random.Random(level)
    for _ in range(5_000):
        places = sum(1 << p for p in chooser.sample(range(64), 4))
        assert any(not mask & places for mask in masks)
    small = simhash.covering_masks(2, level)
    assert all(any(not m & (1 << a | 1 << b) for m in small) for a, b in combinations(range(64), 2))


def test_groups_equal_brute_force(spark, documents):
    found = simhash.groups(documents).collect()
    assert len(found) == documents.count()
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    prints = {(i, brute_print(t)) for i, t in rows}
    assert {(r["doc_id"], r["fp"] & (1 << 64) - 1) for r in found} == prints
    distinct = sorted({p for _, p in prints})
    group = dict(zip(distinct, brute_groups(distinct, simhash.RADIUS)))
    least: dict = {}
    for doc, one in prints:
        if doc is not None:
            least[group[one]] = min(least.get(group[one], doc), doc)
    assert {(r["doc_id"], r["fp"] & (1 << 64) - 1, r["component_id"]) for r in found} == {
        (doc, one, least.get(group[one])) for doc, one in prints
    }


@pytest.mark.parametrize("bucket", [16, 512])
def test_large_buckets_lose_no_link(spark, bucket):
    chooser = random.Random(3)
    base = [chooser.getrandbits(64) for _ in range(4)]
    prints = set(base)
    for start in base:
        for _ in range(30):
            prints.add(start ^ sum(1 << p for p in chooser.sample(range(64), chooser.randint(1, 6))))
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    made = spark.createDataFrame([(p,) for p in signed], "fp long")
    joined = {r["node"]: r["component"] for r in components(simhash.links(made, 4, bucket)).collect()}
    group = brute_groups(prints, 4)
    ours: dict = {}
    for place, one in enumerate(signed):
        ours.setdefault(joined.get(one, one), set()).add(place)
    theirs: dict = {}
    for place, one in enumerate(group):
        theirs.setdefault(one, set()).add(place)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, theirs.values()))


def test_one_of_each_group_stays(spark, documents, nothing):
    kept = simhash.drop_near_copies(documents)
    assert kept.columns == documents.columns
    rows = kept.collect()
    prints = [brute_print(r["text"]) for r in rows]
    assert len(set(brute_groups(sorted(set(prints)), 4))) == len(prints)
    everything = sorted({brute_print(r["text"]) for r in documents.collect()})
    assert len(rows) == len(set(brute_groups(everything, 4)))
    assert simhash.drop_near_copies(nothing).count() == 0
    assert simhash.groups(nothing).count() == 0


def test_components_of_paths_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(5, 5), (9, 8), (8, 9), (None, 3)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    expected = {i: 100 for i in range(100, 161)} | {i: 7 for i in [7, *range(200, 260)]} | {8: 8, 9: 8}
    assert found == expected


def test_majority_needs_more_than_half():
    assert simhash.majority_bits(np.array([1, 2], np.uint64)) == 0
    assert simhash.majority_bits(np.array([3, 1, 4], np.uint64)) == 1
    assert simhash.majority_bits(np.zeros(0, np.uint64)) == 0


@pytest.fixture
def plans(monkeypatch):
    """The plans of all tables that are stored, by label, as they are before they run."""
    found: dict[str, list[str]] = {}

    def noted(module):
        store = module.materialize

        def note(df, label="table"):
            found.setdefault(label, []).append(df._jdf.queryExecution().sparkPlan().toString())
            return store(df, label)

        monkeypatch.setattr(module, "materialize", note)

    noted(simhash)
    noted(sys.modules[components.__module__])
    return found


def test_rows_of_all_tables_are_never_broadcast(spark, plans):
    made = spark.createDataFrame([(i * i * 2654435761,) for i in range(50)], "fp long")
    simhash.links(made, 4, 8)
    simhash.groups(spark.createDataFrame([(1, "a b"), (2, "c d")], "doc_id long, text string")).collect()
    assert plans["simhash-links"]
    for plan in plans["simhash-links"]:
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_many_links_are_never_broadcast(spark, plans, monkeypatch):
    links = spark.createDataFrame([(i, i + 1) for i in range(20)], "a long, b long")
    components(links, "few")
    monkeypatch.setattr(sys.modules[components.__module__], "BROADCAST_ROWS", 5)
    found = {r["node"]: r["component"] for r in components(links, "many").collect()}
    assert found == dict.fromkeys(range(21), 0)
    assert "BroadcastHashJoin" in plans["few"][1]
    assert plans["many"][1:] and not any("Broadcast" in plan for plan in plans["many"][1:])
