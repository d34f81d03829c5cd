from __future__ import annotations

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ordermill.llm import language, quality, toxicity
from tests.llm.conftest import VOCABULARY, corpus, sentence


def held_out_accuracy(found, truth: dict) -> float:
    rows = [(row[1], truth[row[0]]) for row in found if row[0] in truth]
    return sum(a == b for a, b in rows) / len(rows)


def test_language_of_held_out_documents(spark, documents):
    model = language.fit(documents)
    found = language.identify(documents, model)
    rows = found.where("held_out").select("doc_id", "lang_pred").collect()
    truth = {i: lang for i, _, lang, _, _ in corpus() if lang and i not in (3, None)}
    assert held_out_accuracy(rows, truth) > 0.95
    by_id = {row["doc_id"]: row for row in found.collect() if row["doc_id"] is not None}
    assert [by_id[60 + i]["lang_pred"] for i in range(4)] == ["und"] * 4
    assert by_id[60]["score"] == 0.0 and by_id[63]["ambiguous"]
    assert found.count() == documents.count()
    kept = language.keep_identified(documents, model)
    assert kept.columns == documents.columns
    assert {row["doc_id"] for row in kept.collect()} >= set(range(60))


def test_language_without_training_rows(spark, nothing, documents):
    assert language.fit(nothing) is None
    assert language.identify(nothing, None).count() == 0
    assert {row["lang_pred"] for row in language.identify(documents, None).collect()} == {"und"}


def test_without_a_language_texts_with_letters_stay(spark, documents):
    unlabelled = documents.withColumn("lang", F.lit(None).cast("string"))
    model = language.fit(unlabelled)
    assert model is None
    kept = language.keep_identified(unlabelled, model)
    expected = [row["text"] for row in unlabelled.collect() if any(one.isalpha() for one in row["text"] or "")]
    assert sorted(row["text"] for row in kept.collect()) == sorted(expected) and len(expected) > 60
    assert kept.columns == unlabelled.columns


@pytest.mark.parametrize("classes", [1, 2, 3, 4, 7, 12, 40])
def test_codewords_differ_from_each_other(classes):
    codes = language.code_matrix(classes)
    assert codes.shape[0] == classes
    gaps = [(a != b).sum() for i, a in enumerate(codes) for b in codes[:i]]
    assert not gaps or min(gaps) >= (2 if classes > 2 else 1)


def test_a_wrong_bit_is_corrected():
    codes = language.code_matrix(4)
    for row in codes:
        for bit in range(codes.shape[1]):
            margins = 3 * row.copy()
            margins[bit] *= -1
            losses = [sum(abs(m - 3 * c) for m, c in zip(margins, code)) for code in codes]
            assert losses.index(min(losses)) == codes.tolist().index(row.tolist())


def toxic_rows() -> list[tuple]:
    chooser = random.Random(5)
    rows = []
    for number in range(240):
        parts = [sentence(VOCABULARY["aa"], chooser, 8) for _ in range(chooser.randint(1, 8))]
        if number % 2:
            at = chooser.randrange(len(parts))
            parts[at] = parts[at][:-1] + " " + chooser.choice(["vileness", "scoundrels", "wretched"]) + "."
        rows.append((number, " ".join(parts), number % 2))
    return rows


def test_toxicity_finds_documents_and_sentences(spark):
    rows = toxic_rows()
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").selectExpr("*", "'x' label", "9 score")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(999, None), (None, 1), (0, 0)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    found = toxicity.detect(docs, model).collect()
    truth, text = {i: y for i, _, y in rows}, {i: t for i, t, _ in rows}
    held = [row for row in found if row["held_out"]]
    assert all(row["predicted"] == truth[row["doc_id"]] for row in held) and len(held) > 50
    for row in held:
        for span in row["offending"]:
            part = text[row["doc_id"]][span["start"] : span["start"] + span["length"]]
            assert any(word in part for word in ("vileness", "scoundrels", "wretched"))
        assert bool(row["offending"]) == bool(truth[row["doc_id"]])


def test_noisy_or_of_sentences():
    model = toxicity.train(["bad word here. fine words there.", "fine words there. fine words."] * 8, [1, 0] * 8)
    score = toxicity.scorer(model, 0.0)
    whole, = score(pa.array(["bad word here. fine words there."])).to_pylist()
    rest = 1.0
    for span in whole["offending"]:
        rest *= 1 - span["score"]
    assert whole["score"] == pytest.approx(1 - rest, abs=1e-9)
    empty = score(pa.array([None, "", "...", "\n"], pa.string())).to_pylist()
    assert all(0 <= one["score"] < 0.01 for one in empty)
    assert score(pa.array([], pa.string())).to_pylist() == []


def test_clean_sentences_add_up_to_nothing():
    model = toxicity.train(["bad word here. fine words there.", "fine words there. fine words."] * 8, [1, 0] * 8)
    score = toxicity.scorer(model, 0.5)
    lines = "fine words there\n" * 100_000
    clean, rest = score(pa.array([lines, lines + "bad word here."])).to_pylist()
    assert clean == {"score": 0.0, "offending": []}
    assert rest["score"] >= toxicity.THRESHOLD and len(rest["offending"]) == 1


def test_toxicity_odd_rows(spark, documents, nothing):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.fit(documents, labels) is None
    assert {row["score"] for row in toxicity.detect(documents, None).collect()} == {0.0}
    model = toxicity.train(["bad.", "good."] * 4, [1, 0] * 4)
    assert toxicity.detect(documents, model).count() == documents.count()
    assert toxicity.detect(nothing, model).count() == 0


def test_quality_of_held_out_documents(spark, nothing, documents):
    chooser = random.Random(8)
    rows = []
    for number in range(240):
        words = [chooser.choice(VOCABULARY["bb"]) for _ in range(chooser.randint(20, 200))]
        junk = [word.upper() + "!!" for word in words]
        rows.append((number, " ".join(words if number % 2 else junk), number % 2))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").selectExpr("*", "9 score", "'x' text_")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    found = [row for row in quality.classify(docs, model).collect() if row["held_out"]]
    assert sum(row["predicted"] == row["doc_id"] % 2 for row in found) / len(found) > 0.95
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns
    odd = quality.classify(documents, model).collect()
    assert len(odd) == documents.count() and all(0 <= row["score"] <= 1 for row in odd)
    assert quality.classify(nothing, model).count() == 0
    assert quality.fit(docs, labels.where("quality = 1")) is None
    assert {row["score"] for row in quality.classify(documents, None).collect()} == {0.5}


@pytest.mark.parametrize("size", [0, 1, 7, 511, 512, 513, 960, 961, 5000])
def test_chunks_cover_every_byte(size):
    data = bytes(i % 251 for i in range(size))
    rows = quality.chunks_of(data)
    step = quality.CHUNK - quality.OVERLAP
    seen = {}
    for number, row in enumerate(rows.tolist()):
        for at, byte in enumerate(row):
            if byte != quality.PAD:
                assert seen.setdefault(number * step + at, byte) == byte
    assert bytes(seen[i] for i in range(size)) == data and len(seen) == size


def test_scores_do_not_depend_on_neighbours():
    texts = ["word " * 40_000, "short", "", "Straße " * 100]
    model = quality.train(texts[:2] * 4, [1, 0] * 4, epochs=2)
    together = quality.score(pa.array(texts), model)
    alone = [quality.score(pa.array([text]), model)[0] for text in texts]
    assert together == pytest.approx(alone, abs=1e-5)
