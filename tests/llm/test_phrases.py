from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from ordermill.llm import phrases


def brute(rows, least, top):
    """(lang, rank, phrase, a, l, r, n, score) by plain counting."""
    f: dict = defaultdict(Counter)
    for lang, text in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size in range(1, 6):
                f[lang or "und"].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    found = []
    for lang, counts in f.items():
        n = sum(c for p, c in counts.items() if len(p) == 1)
        often = {p: c for p, c in counts.items() if len(p) > 1 and c >= least}
        covered = {p[i : i + k] for p, c in often.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if c >= often[p[i : i + k]]}
        scored = []
        for p, a in often.items():
            if p in covered:
                continue
            cuts = [(1000 * a * n // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(found)


def invented(seed: int, count: int) -> list[tuple]:
    chooser = random.Random(seed)
    rows = []
    for number in range(count):
        words = [f"w{int(chooser.paretovariate(0.9)) % 40}" for _ in range(chooser.randint(0, 120))]
        words = [w.upper() if chooser.random() < 0.1 else w + chooser.choice(["", "", "", ".", ",x", "\n", "?!"]) for w in words]
        rows.append((chooser.choice(["aa", "aa", "bb", None]), chooser.choice([" ", " ", "\t "]).join(words)))
    rows += [("aa", None), ("bb", ""), (None, " \t "), ("aa", "... !!"), ("cc", "once"), ("aa", "of the " * 3000), ("aa", "the same line of seven words here. " * 400)]
    return rows + rows[:3]


def result(df) -> list[tuple]:
    return sorted((r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in df.collect())


@pytest.fixture(scope="module")
def texts(spark):
    rows = invented(4, 60)
    df = spark.createDataFrame(rows, "lang string, text string").selectExpr("*", "'x' phrase", "1 n", "2 grp", "3 word", "4 a").repartition(3)
    return rows, df


@pytest.mark.parametrize("budget", [8, 300, None])
def test_collocations_equal_brute_force(texts, budget):
    rows, df = texts
    assert result(phrases.collocations(df, least=6, top=50, budget=budget)) == brute(rows, 6, 50)


@pytest.mark.parametrize("budget", [4, 80, 4000])
def test_all_counts_equal_brute_force_with_extended_prefixes(texts, budget):
    rows, df = texts
    found = phrases.frequent_phrases(df, phrases.word_counts(df), least=4, budget=budget).collect()
    wanted: Counter = Counter()
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").lower()):
            parts = piece.split()
            wanted.update((lang or "und", " ".join(parts[i : i + k])) for k in range(1, 6) for i in range(len(parts) - k + 1))
    assert sorted(tuple(r) for r in found) == sorted((a, b, n) for (a, b), n in wanted.items() if n >= 4)


def test_heavy_prefixes_are_spread_over_groups(spark):
    chooser = random.Random(8)
    rows = [("aa", f"of the {chooser.choice('abcdefgh')} {chooser.choice('xyz')} end") for _ in range(400)]
    df = spark.createDataFrame(rows, "lang string, text string")
    words = phrases.word_counts(df)
    often = words.selectExpr("crc32(concat(cast(lang as binary), X'00', cast(word as binary))) & 16777215 slot")
    known = phrases.bitmap_of(often, phrases.WORD_BITS)
    full = np.full(1 << phrases.PAIR_BITS >> 3, 255, np.uint8)
    dealt = phrases.dealt_suffixes(df, phrases.Partition(50, known, full, {"aa": ["of the"]})).collect()
    groups = Counter()
    for row in dealt:
        if "of" in row["words"]:
            groups[row["grp"]] += 1
    assert len(groups) > 4  # one for each word that follows, but for shared groups


def test_large_products_stay_exact(spark):
    expr = "div(1000 * cast(a as decimal(18,0)) * cast(n as decimal(16,0)), cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"
    a, n, left, right = 987_654_321_987, 9_876_543_210_987_654, 999_999_999_999, 987_654_321_989
    row = spark.createDataFrame([(a, n, left, right)], "a long, n long, l long, r long").selectExpr(f"{expr} s").first()
    assert row["s"] == 1000 * a * n // (left * right)


def test_empty_tables_and_rare_words(spark, nothing):
    assert phrases.collocations(nothing).collect() == []
    one = spark.createDataFrame([(1, "just one line", "aa")], "doc_id long, text string, lang string")
    assert phrases.collocations(one).collect() == []
