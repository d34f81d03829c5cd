"""Toxicity by multiple-instance learning: only documents are labelled, sentences are scored.

A document is toxic if at least one of its sentences is: with sentence
chances p(s), the document's is the noisy-or 1 - product(1 - p(s)). The
sentence model, logistic over hashed n-grams of letters, is trained through
that combination, so it learns to find the offending sentences by itself. The
logistic chance of a sentence without evidence is taken off and the rest
rescaled, so such sentences have the chance 0 and a text may have any number
of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.llm.batches import SMALL_SLICE, slices
from ordermill.llm.folds import fold, labelled_texts
from ordermill.llm.linear import Adam, code_points, letter_grams, sigmoid, summed

PER_LABEL = 1200  # training documents of either label
TRAIN_CHARS = 6000  # characters of each training document
GRAMS = (4, 5, 6)
FEATURES = 1 << 18
EPOCHS = 40
BIAS = -9.0  # logit of a sentence without evidence, which has the chance 0
LEAK = 0.05  # chance of a training document without evidence, so that learning can start there
SPARSE = 3e-4  # price of a unit of weight, per gram
THRESHOLD = 0.7
SENTENCE_ENDS = ".!?\n"
FOLDS, HELD_OUT = 3, 1
SPANS = T.ArrayType(
    T.StructType(
        [T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("score", T.DoubleType())]
    )
)
RESULT = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("offending", SPANS)])


@dataclass
class Model:
    weights: np.ndarray  # FEATURES x 1
    bias: float


def sentences(points: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Start of every sentence of all texts: at each text's start and behind each run of sentence marks."""
    marks = np.isin(points, [ord(mark) for mark in SENTENCE_ENDS])
    behind = np.flatnonzero(marks[:-1] & ~marks[1:]) + 1
    return np.union1d(behind, offsets[:-1])


def log_clean(logits: np.ndarray, bias: float = BIAS) -> np.ndarray:
    """log(1 - p) of sentences with the given logits; exactly 0 at the bias, so any number of them adds nothing."""
    return np.logaddexp(0.0, bias) - np.logaddexp(0.0, logits)


def train(texts: list[str], labels: list[int], epochs: int = EPOCHS) -> Model:
    """Weights that minimise the log loss of the noisy-or of sentence scores against document labels.

    Weights stay at zero or above and pay ``SPARSE`` each: grams are evidence
    of toxicity or none, so a long clean part of a sentence hides nothing.
    """
    points, offsets = code_points(pa.array(texts, pa.string()))
    at, places = letter_grams(points, GRAMS, FEATURES)
    starts = sentences(points, offsets)
    sentence = np.searchsorted(starts, at, side="right") - 1
    doc = np.searchsorted(offsets, starts, side="right") - 1
    first = np.flatnonzero(np.diff(sentence, prepend=-1))
    owner = sentence[first]
    label = np.asarray(labels, float)
    balance = np.where(label == 1, 0.5 / max(label.sum(), 1), 0.5 / max((1 - label).sum(), 1))
    weights = np.zeros(FEATURES, np.float32)
    step_weights = Adam(FEATURES, 0.1)
    for _ in range(epochs):
        values = sum(weights[places[:, n]] for n in range(len(GRAMS)))
        logits = np.full(len(starts), BIAS)
        logits[owner] += np.add.reduceat(values, first) if len(first) else 0.0
        clean = np.bincount(doc, log_clean(logits), len(texts))
        clean += np.log1p(-LEAK)
        odds = np.exp(clean) / -np.expm1(clean)  # (1 - p) / p of each document
        slope = (balance * np.where(label == 1, -odds, 1.0))[doc] * sigmoid(logits)
        per_letter = np.repeat(slope[owner], np.diff(np.append(first, len(at))))
        gradient = sum(np.bincount(places[:, n], per_letter, FEATURES) for n in range(len(GRAMS)))
        weights += step_weights((gradient + SPARSE).astype(np.float32))
        np.maximum(weights, 0.0, out=weights)
    return Model(weights[:, None], BIAS)


def fit(documents: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, max_chars: int = TRAIN_CHARS) -> Model | None:
    """A model from a bounded sample of labelled documents outside the held-out fold; None if it lacks a label."""
    usable = labels.where(fold("doc_id", FOLDS) != HELD_OUT)
    texts, known = labelled_texts(documents, usable, "toxic", per_label, max_chars)
    return train(texts, known) if len(set(known)) == 2 else None


def scorer(model: Model | None, spans_from: float | None) -> Callable[[pa.Array], pa.StructArray]:
    """Score of whole texts, and their sentences with at least the chance ``spans_from`` (None: no spans)."""

    def score(texts: pa.Array) -> pa.StructArray:
        points, offsets = code_points(texts)
        starts = sentences(points, offsets) if len(texts) else offsets[:0]
        bias = model.bias if model else BIAS
        logits = np.full(len(starts), bias)
        if model and len(starts):
            logits += summed(points, starts, GRAMS, model.weights)[:, 0]
        doc = np.searchsorted(offsets, starts, side="right") - 1
        clean = log_clean(logits, bias)
        chance, each = 0.0 - np.expm1(np.bincount(doc, clean, len(texts))), 0.0 - np.expm1(clean)
        hit = np.flatnonzero(each >= (2.0 if spans_from is None else spans_from))
        ends = np.append(starts[1:], offsets[-1:])
        ends = np.minimum(ends, offsets[doc + 1] - 1)
        spans = pa.StructArray.from_arrays(
            [
                pa.array(starts[hit] - offsets[doc[hit]]),
                pa.array(ends[hit] - starts[hit]),
                pa.array(each[hit]),
            ],
            ["start", "length", "score"],
        )
        counts = np.concatenate([[0], np.cumsum(np.bincount(doc[hit], minlength=len(texts)))])
        lists = pa.ListArray.from_arrays(pa.array(counts, pa.int32()), spans)
        return pa.StructArray.from_arrays([pa.array(np.clip(chance, 0.0, 1.0)), lists], ["score", "offending"])

    return score


def predictor(model: Model | None, spans_from: float | None = 0.5) -> Callable[[Column | str], Column]:
    """A column function: text to (score, offending sentences as code point spans)."""

    @F.arrow_udf(RESULT)
    def predict(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        score = scorer(model, spans_from)
        for part in texts:
            batch = pa.RecordBatch.from_arrays([part], ["text"])
            found = [score(one.column("text")) for one in slices(batch, limit=SMALL_SLICE)]
            yield pa.concat_arrays(found) if found else score(part)

    return predict


def detect(documents: DataFrame, model: Model | None, spans_from: float | None = 0.5) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted``, ``offending`` of every document.

    ``offending``: start, length (code points) and score of each sentence of
    chance ``spans_from`` or more. A null text counts as empty and is scored
    like a text without letters, 0. Without a model (no
    labels of one kind) every score is 0. Rows with null or repeated ids are
    kept; a null id is held out. Extra columns are not read.
    """
    predict = predictor(model, spans_from)
    return documents.select(
        "doc_id",
        (F.coalesce(fold("doc_id", FOLDS), F.lit(HELD_OUT)) == HELD_OUT).alias("held_out"),
        predict(F.col("text").cast("string")).alias("_found"),
    ).select(
        "doc_id", "held_out", "_found.score",
        F.when(F.col("_found.score") >= THRESHOLD, 1).otherwise(0).alias("predicted"), "_found.offending",
    )
