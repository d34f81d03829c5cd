"""Language identification by error-correcting output codes.

Every language has a codeword of bits. One binary classifier per bit, over
character n-grams of words, is trained to tell the languages with that bit
from those without. A text is decoded to the codeword with the least loss,
each bit weighted by how reliable its classifier was in training.
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
from ordermill.llm.folds import fold, stratified
from ordermill.llm.linear import Adam, code_points, letter_grams, sigmoid, summed

UNKNOWN = "und"
PER_LANGUAGE = 400  # training documents of each language
TRAIN_CHARS = 4000  # characters of each training document
GRAMS = (1, 2, 3)
FEATURES = 1 << 14
BATCH = 256
EPOCHS = 16
AMBIGUOUS = 0.55  # a score below is flagged as ambiguous
FOLDS, HELD_OUT = 4, 2
RESULT = T.StructType(
    [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("ambiguous", T.BooleanType()),
        T.StructField("second", T.StringType()),
    ]
)


def code_matrix(classes: int, seed: int = 7) -> np.ndarray:
    """A codeword of +1/-1 per class, one column per bit; columns and their complements are never repeated.

    Up to seven classes: all splits of the classes. More: the best of some
    random matrices of 12 log2(classes) bits by the least distance of two
    codewords.
    """
    if classes == 1:
        return np.ones((1, 1))
    if classes <= 7:
        columns = [[1] + [1 if bits >> i & 1 else -1 for i in range(classes - 1)] for bits in range((1 << classes - 1) - 1)]
        return np.array(columns, float).T
    random = np.random.default_rng(seed)
    bits = int(np.ceil(12 * np.log2(classes)))
    best, distance = None, -1.0
    for _ in range(50):
        matrix = np.where(random.random((classes, bits)) < 0.5, -1.0, 1.0)
        near = ((bits - matrix @ matrix.T) / 2 + bits * np.eye(classes)).min()
        if near > distance and (np.abs(matrix.sum(0)) < classes).all():
            best, distance = matrix, near
    if best is None:
        raise AssertionError("no code found")
    return best


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray  # languages x bits
    weights: np.ndarray  # FEATURES x bits
    bias: np.ndarray  # bits
    trust: np.ndarray  # bits; sums to their number

    def scores(self, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """A probability per language from summed weights and numbers of letters."""
        margins = sums / np.maximum(counts, 1)[:, None] + self.bias
        loss = np.logaddexp(0.0, -margins[:, None, :] * self.codes[None]) @ self.trust
        shifted = np.exp(loss.min(1, keepdims=True) - loss)
        return shifted / shifted.sum(1, keepdims=True)


def train(texts: list[str], languages: list[str], epochs: int = EPOCHS) -> Model:
    """Logistic regression of every bit over mean n-gram counts, all bits at once, in mini-batches."""
    names = sorted(set(languages))
    codes = code_matrix(len(names))
    target = codes[[names.index(language) for language in languages]].astype(np.float32)
    points, offsets = code_points(pa.array(texts, pa.string()))
    at, places = letter_grams(points, GRAMS, FEATURES)
    spans = np.searchsorted(at, offsets)
    bits = codes.shape[1]
    weights, bias = np.zeros((FEATURES, bits), np.float32), np.zeros(bits, np.float32)
    step_weights, step_bias = Adam(weights.shape, 0.5), Adam(bias.shape, 0.05)
    order = np.random.default_rng(5).permutation(len(texts))
    batches = [np.sort(order[i : i + BATCH]) for i in range(0, len(order), BATCH)]

    def counted(batch: np.ndarray) -> np.ndarray:
        table = np.zeros((len(batch), FEATURES), np.float32)
        for row, text in zip(table, batch):
            found = places[spans[text] : spans[text + 1]].ravel()
            row += np.bincount(found, minlength=FEATURES) / max(len(found) / len(GRAMS), 1)
        return table

    for _ in range(epochs):
        for batch in batches:
            table = counted(batch)
            slope = -target[batch] * sigmoid(-target[batch] * (table @ weights + bias)) / len(batch)
            bias += step_bias(slope.sum(0))
            weights += step_weights(table.T @ slope + 1e-6 * weights)
    right = sum(((counted(batch) @ weights + bias) * target[batch] > 0).sum(0) for batch in batches)
    trust = np.maximum(right / len(texts) - 0.5, 0.01)
    return Model(names, codes, weights, bias, trust * len(trust) / trust.sum())


def fit(documents: DataFrame, per_language: int = PER_LANGUAGE, max_chars: int = TRAIN_CHARS) -> Model | None:
    """A model from text and non-null lang of the documents outside the held-out fold.

    A bounded sample: about ``per_language`` documents of each language, the
    first ``max_chars`` characters of each; rarer languages give all they
    have. None where no document has both.
    """
    usable = documents.where(
        (F.coalesce(fold("doc_id", FOLDS), F.lit(HELD_OUT)) != HELD_OUT) & F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    sample = stratified(usable.select("doc_id", "lang", "text"), "doc_id", "lang", per_language)
    rows = sample.select("doc_id", "lang", F.substring("text", 1, max_chars).alias("text")).collect()
    rows.sort(key=lambda row: (row["doc_id"], row["lang"], row["text"]))
    return train([row["text"] for row in rows], [row["lang"] for row in rows]) if rows else None


def scorer(model: Model | None) -> Callable[[pa.Array], pa.StructArray]:
    """Language, score, ambiguity and runner-up of whole texts."""
    def score(texts: pa.Array) -> pa.StructArray:
        names = np.array([UNKNOWN, *(model.languages if model else [])], object)
        best, second = np.zeros(len(texts), int), np.zeros(len(texts), int)
        sure, unsure = np.zeros(len(texts)), np.ones(len(texts), bool)
        if model and len(texts):
            points, offsets = code_points(texts)
            sums = summed(points, offsets[:-1], GRAMS, model.weights)
            lettered = np.flatnonzero(sums[:, -1])
            chances = model.scores(sums[lettered, :-1], sums[lettered, -1])
            order = np.argsort(-chances, axis=1, kind="stable")
            best[lettered] = order[:, 0] + 1
            second[lettered] = order[:, 1] + 1 if len(model.languages) > 1 else 0
            sure[lettered] = chances[np.arange(len(lettered)), order[:, 0]]
            unsure[lettered] = sure[lettered] < AMBIGUOUS
        return pa.StructArray.from_arrays(
            [pa.array(names[best], pa.string()), pa.array(sure), pa.array(unsure), pa.array(names[second], pa.string())],
            ["lang_pred", "score", "ambiguous", "second"],
        )

    return score


def predictor(model: Model | None) -> Callable[[Column | str], Column]:
    """A column function: text to (lang_pred, score, ambiguous, second)."""

    @F.arrow_udf(RESULT)
    def predict(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        score = scorer(model)
        for part in texts:
            batch = pa.RecordBatch.from_arrays([part], ["text"])
            found = [score(one.column("text")) for one in slices(batch, limit=SMALL_SLICE)]
            yield pa.concat_arrays(found) if found else score(part)

    return predict


def identify(documents: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score``, ``ambiguous``, ``second`` of every document.

    A null text or one without letters is ``und`` with score 0, and so is
    any text where no language could be learned. Rows with null or repeated
    ids are kept; a null id is held out. Extra columns are not read.
    """
    predict = predictor(model)
    return documents.select(
        "doc_id",
        (F.coalesce(fold("doc_id", FOLDS), F.lit(HELD_OUT)) == HELD_OUT).alias("held_out"),
        predict(F.col("text").cast("string")).alias("_found"),
    ).select("doc_id", "held_out", "_found.*")


def keep_identified(documents: DataFrame, model: Model | None) -> DataFrame:
    """Documents with a language told apart from the others, with all their columns.

    Where no language could be learned nothing can be told apart, and every
    document whose text has a letter is kept.
    """
    if model is None:
        return documents.where(F.col("text").cast("string").rlike(r"\p{L}"))
    found = predictor(model)(F.col("text").cast("string"))
    return documents.where(~found["ambiguous"])
