from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ordermill.llm import spelling


def brute_counts(rows, mod=spelling.DELETE_MOD) -> Counter:
    counts: Counter = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % mod == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= 6:
                counts[run] += 1
    return counts


def edits(word: str, letters: list[str]) -> set[str]:
    cuts = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    found = {a + b[1:] for a, b in cuts if b}
    found |= {a + x + b[1:] for a, b in cuts if b for x in letters}
    found |= {a + x + b for a, b in cuts for x in letters}
    return found - {word}


def brute_groups(words: dict[str, int]) -> set[tuple]:
    letters = sorted(set("".join(words)))
    near = {word: sorted((e for e in edits(word, letters) if e in words), key=lambda e: (-words[e], e)) for word in words}
    form = {w: near[w][0] if near[w] and words[near[w][0]] >= 5 * words[w] else None for w in words}
    rows = set()
    for word, n in words.items():
        root = word
        while form[root]:
            root = form[root]
        rows.add((word, form[word], root, n, len(near[word]), words[form[word]] if form[word] else None))
    return rows


def result(df) -> list[tuple]:
    return [(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()]


def invented(seed: int, count: int) -> list[str]:
    """Words with many near ones, anagrams, repeated letters and letters beyond ASCII."""
    chooser = random.Random(seed)
    base = ["".join(chooser.choice("abcdeéÿ") for _ in range(chooser.randint(6, 8))) for _ in range(count)]
    base += ["".join(chooser.sample("abcdef", 6)) for _ in range(count)]  # one vector for all
    base += ["a" * 300, "a" * 301, "a" * 299 + "b", "ab" * 40, "ab" * 40 + "a", "ba" * 40]
    return sorted(set(base))


@pytest.mark.parametrize("limit", [1 << 15, 7])
def test_near_words_equal_brute_force(spark, limit):
    chooser = random.Random(3)
    words = {word: chooser.choice([5, 6, 30, 31, 200]) for word in invented(1, 150)}
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    found = {(r["word"], r["n_near"], r["best"], r["best_n"]) for r in spelling.near_words(df, limit).collect()}
    letters = sorted(set("".join(words)))
    wanted = set()
    for word in words:
        near = sorted((e for e in edits(word, letters) if e in words), key=lambda e: (-words[e], e))
        if near:
            wanted.add((word, len(near), near[0], words[near[0]]))
    assert found == wanted


@pytest.mark.parametrize("limit", [1 << 15, 11])
def test_groups_of_texts_equal_brute_force(spark, limit):
    chooser = random.Random(5)
    names = invented(2, 60)
    weights = [chooser.choice([1, 1, 2, 20, 150]) for _ in names]
    texts = [" ".join(chooser.choices(names, weights, k=400)) for _ in range(20)]
    rows = [(i, text) for i, text in enumerate(texts)]
    rows += [(7, "Ábcdefg× ABCDEF" * 20), (None, "abcdef " * 30), (21, None), (22, ""), (23, "12 ;"), (24, "xyzxyzx" * 3000), (24, texts[0])]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' word", "1 n", "2 vec", "3 node", "4 best").repartition(3)
    counts = {word: n for word, n in brute_counts(rows).items() if n >= 5}
    assert any(word not in names for word in counts) or len(counts) > 100
    found = result(spelling.variant_groups(df, limit=limit))
    assert len(found) == len(set(found))
    assert set(found) == brute_groups(counts)


def test_chains_of_forms_lead_to_their_end(spark):
    rows = [(1, "aaaaaa " * 5 + "aaaaab " * 25 + "aaaabb " * 125 + "aaabbb " * 625 + "lonely " * 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r[0]: r for r in result(spelling.variant_groups(df, delete_mod=1 << 40))}
    assert found["aaaaaa"][1:3] == ("aaaaab", "aaabbb") and found["aaabbb"][1:3] == (None, "aaabbb")
    assert found["lonely"] == ("lonely", None, "lonely", 5, 0, None)


def test_a_deleted_letter_follows_the_hash(spark):
    run = next(w for w in ("letter" + a + b for a in "abcdefgh" for b in "abcdefgh") if zlib.crc32(f"9:{w}".encode()) % 5 == 0)
    df = spark.createDataFrame([(9, f"{run} {run.upper()}")], "doc_id long, text string")
    at = zlib.crc32(f"9:{run}".encode()) % len(run)
    assert {tuple(r) for r in spelling.run_counts(df, delete_mod=5).collect()} == {(run[:at] + run[at + 1 :], 2)}


def test_empty_tables(spark, nothing):
    assert spelling.variant_groups(nothing).collect() == []


def test_equal_counts_are_cut_off_without_losing_pairs():
    vecs = spelling.vectors(["e" * 300, "e" * 301, "et"])
    assert vecs.dtype == np.uint8 and vecs[0].tolist() == vecs[1].tolist() and vecs[2][:2].tolist() == [1, 1]


def test_one_edit():
    assert spelling.one_edit("abc", "abxc") and spelling.one_edit("abc", "axc") and spelling.one_edit("abc", "bc")
    assert not spelling.one_edit("abc", "abc") and not spelling.one_edit("abc", "acb") and not spelling.one_edit("ab", "abcd")
