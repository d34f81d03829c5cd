from __future__ import annotations

import hashlib
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from ordermill.llm import winnowing

MASK = (1 << 64) - 1


def brute_marks(text: str | None) -> list[tuple[int, int]]:
    tokens = re.findall(r"[^ \t\n\x0b\f\r]{1,%d}" % winnowing.TOKEN_CHARS, text or "")
    hashes = [xxhash.xxh64_intdigest(token.encode(), 42) for token in tokens]
    width = winnowing.GRAM if len(hashes) >= winnowing.GRAM else len(hashes)
    grams = []
    for at in range(len(hashes) - width + 1 if hashes else 0):
        total = 0
        for one in hashes[at : at + width]:
            total = ((total << 1 | total >> 63) & MASK) ^ one
        grams.append(total)
    kept = set()
    for start in range(1 - winnowing.WINDOW, len(grams)) if grams else ():
        window = range(max(start, 0), min(start + winnowing.WINDOW, len(grams)))
        least = min(grams[at] >> 33 for at in window)
        kept.add(max(at for at in window if grams[at] >> 33 == least))
    return [(at, grams[at] - (1 << 64) if grams[at] >> 63 else grams[at]) for at in sorted(kept)]


def jaccard(a: list, b: list) -> float:
    left, right = {h for _, h in a}, {h for _, h in b}
    return len(left & right) / len(left | right) if left | right else 1.0


def test_report_equals_brute_force(spark, documents):
    rows = [(r["doc_id"], r["text"] or "") for r in documents.select("doc_id", "text").collect()]
    rows.sort(key=lambda row: (row[0] is not None, row[0] or 0, row[1].encode()))
    expected = []
    for at, (doc, text) in enumerate(rows):
        other = rows[(at + 1) % len(rows)][1]
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + other[:quarter]
        marks, after = brute_marks(text), brute_marks(edited)
        expected.append((
            doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), marks, after,
            jaccard(marks, after), jaccard(marks, brute_marks(other)),
        ))
    found = [
        (r[0], r[1], r[2], [tuple(m) for m in r[3]], [tuple(m) for m in r[4]], r[5], r[6])
        for r in winnowing.edit_report(documents).collect()
    ]
    assert sorted(found, key=str) == sorted(expected, key=str)


@pytest.mark.parametrize("buckets", [1, 2, 50])
def test_next_text_over_any_number_of_ranges(spark, buckets):
    rows = [(i * 3, f"text {i}") for i in range(40)]
    made = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {r["text"]: r["next_text"] for r in winnowing.with_next_text(made, buckets).collect()}
    assert found == {f"text {i}": f"text {(i + 1) % 40}" for i in range(40)}


def test_single_and_no_document(spark, nothing):
    one = spark.createDataFrame([(5, "abcd efgh")], "doc_id long, text string")
    row = winnowing.edit_report(one).first()
    assert row["near_next"] == 1.0 and row["n_chars"] == 9
    assert winnowing.edit_report(nothing).count() == 0


def test_shared_passages_share_a_mark(spark):
    passage = " ".join(f"w{i * 7919 % 1000}" for i in range(winnowing.GRAM + winnowing.WINDOW - 1))
    rows = [(i, " ".join(f"own{i}x{j}" for j in range(i + 5)) + f" {passage} " + f"tail{i} " * i) for i in range(30)]
    made = spark.createDataFrame(rows, "doc_id long, text string")
    marks = made.select(F.transform(winnowing.fingerprint(F.col("text"))["hash"], lambda h: h).alias("h")).collect()
    assert set.intersection(*[set(row["h"]) for row in marks])


def test_equal_hashes_keep_the_rightmost(spark):
    made = spark.createDataFrame([("same " * 12,)], "text string")
    marks = made.select(winnowing.fingerprint(F.col("text")).alias("m")).first()["m"]
    assert [m["position"] for m in marks] == [p for p, _ in brute_marks("same " * 12)]
