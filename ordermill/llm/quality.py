"""Quality classification by a byte-level convolutional network in numpy.

Bytes get learned vectors; filters of ``WIDTH`` bytes slide over overlapping
chunks that cover the whole document; each filter keeps its maximum per
chunk. The mean and the maximum of those over all chunks are combined into
one probability. A chunk's network sees the same bytes wherever the chunk
stands, so documents of any length cost time in proportion and no more memory.
How much of the first chunk is text goes in as well, for very short documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.batches import SMALL_SLICE, filled, slices
from ordermill.llm.folds import fold, labelled_texts
from ordermill.llm.linear import Adam, sigmoid

PER_LABEL = 1500  # training documents of either label
TRAIN_CHARS = 4096  # characters of each training document
STRIDE = 4
WIDTH = 2 * STRIDE
DIMENSIONS = 8
FILTERS = 48
CHUNK = 512  # bytes
OVERLAP = 64  # bytes a chunk shares with the next one
EPOCHS = 14
BATCH = 128
AT_ONCE = 1 << 10  # chunks in memory at once
THRESHOLD = 0.5
FOLDS, HELD_OUT = 3, 1
PAD = 256  # stands for bytes outside the text; its vector stays zero


@dataclass
class Model:
    table: np.ndarray  # 257 x DIMENSIONS
    filters: np.ndarray  # WIDTH * DIMENSIONS x FILTERS
    shift: np.ndarray  # FILTERS
    dense: np.ndarray  # 2 * FILTERS + 1
    bias: float


def chunks_of(data: bytes) -> np.ndarray:
    """Overlapping chunks that cover all bytes, as rows of byte numbers, padded; one row at least."""
    step = CHUNK - OVERLAP
    count = max(1, -(-max(len(data) - OVERLAP, 1) // step))
    padded = np.full(count * step + OVERLAP, PAD, np.int16)
    padded[: len(data)] = np.frombuffer(data, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::step]


def chunk_maxima(rows: np.ndarray, model: Model, places: bool = False):
    """Largest response of each filter in each chunk (and where); all windows of WIDTH bytes, STRIDE apart."""
    groups = model.table[rows].reshape(len(rows) * (CHUNK // STRIDE), STRIDE * DIMENSIONS)
    half = len(model.filters) // 2
    left = (groups @ model.filters[:half]).reshape(len(rows), CHUNK // STRIDE, -1)
    right = (groups @ model.filters[half:]).reshape(len(rows), CHUNK // STRIDE, -1)
    responses = left[:, :-1] + right[:, 1:]
    best = responses.max(1)
    values = np.maximum(best + model.shift, 0.0)
    return (values, responses.argmax(1)) if places else values


def fill(data: bytes) -> float:
    """Share of the first chunk that is text: a short text shows few patterns, good or bad."""
    return min(len(data), CHUNK) / CHUNK


def crops(texts: list[str], random: np.random.Generator) -> list[str]:
    """A short piece of every text, so that short documents are learned too."""
    sizes = random.integers(20, 300, len(texts))
    starts = [int(random.integers(0, max(len(text) - size, 0) + 1)) for text, size in zip(texts, sizes)]
    return [text[start : start + size] for text, start, size in zip(texts, starts, sizes)]


def _initial(random: np.random.Generator) -> Model:
    table = random.normal(0, 0.5, (PAD + 1, DIMENSIONS)).astype(np.float32)
    table[PAD] = 0
    size = WIDTH * DIMENSIONS
    filters = random.normal(0, np.sqrt(2 / size), (size, FILTERS)).astype(np.float32)
    return Model(table, filters, np.zeros(FILTERS, np.float32), random.normal(0, 0.1, 2 * FILTERS + 1).astype(np.float32), 0.0)


def train(texts: list[str], labels: list[int], epochs: int = EPOCHS, seed: int = 3) -> Model:
    """Minimise the log loss by mini-batches; gradients flow through the windows that gave the maxima."""
    random = np.random.default_rng(seed)
    model = _initial(random)
    names = ("table", "filters", "shift", "dense")
    rates = {"table": 0.01, "filters": 0.01, "shift": 0.01, "dense": 0.01}
    steps = {name: Adam(getattr(model, name).shape, rates[name]) for name in names}
    step_bias = Adam(1, 0.01)
    texts, labels = texts + crops(texts, random), labels + labels
    encoded = [text.encode() for text in texts]
    rows_of, filled_by = [chunks_of(text) for text in encoded], np.array([fill(text) for text in encoded])
    label = np.asarray(labels, np.float32)
    weight = np.where(label == 1, 0.5 / max(label.mean(), 1e-6), 0.5 / max(1 - label.mean(), 1e-6))
    order = np.arange(len(texts))
    for _ in range(epochs):
        random.shuffle(order)
        for at in range(0, len(order), BATCH):
            batch = order[at : at + BATCH]
            rows = np.concatenate([rows_of[i] for i in batch])
            counts = np.array([len(rows_of[i]) for i in batch])
            starts = np.cumsum(counts) - counts
            owner = np.repeat(np.arange(len(batch)), counts)
            values, where = chunk_maxima(rows, model, places=True)
            mean = np.add.reduceat(values, starts, axis=0) / counts[:, None]
            most = np.maximum.reduceat(values, starts, axis=0)
            pooled = np.hstack([mean, most, filled_by[batch, None]])
            chance = sigmoid(pooled @ model.dense + model.bias)
            slope = (weight[batch] * (chance - label[batch]) / len(batch)).astype(np.float32)
            grad_dense = pooled.T @ slope
            grad_mean = slope[:, None] * model.dense[None, :FILTERS] / counts[:, None]
            grad_most = slope[:, None] * model.dense[None, FILTERS : 2 * FILTERS]
            top = values == most[owner]
            flow = (grad_mean[owner] + grad_most[owner] * top) * (values > 0)
            chunk, kind = np.nonzero(flow)
            amount = flow[chunk, kind].astype(np.float32)
            windows = rows[chunk[:, None], where[chunk, kind][:, None] * STRIDE + np.arange(WIDTH)]
            seen = model.table[windows].reshape(len(chunk), -1)
            by_kind = np.argsort(kind, kind="stable")
            ends = np.searchsorted(kind[by_kind], np.arange(FILTERS + 1))
            grad_filters = np.zeros_like(model.filters)
            for f in range(FILTERS):
                own = by_kind[ends[f] : ends[f + 1]]
                grad_filters[:, f] = amount[own] @ seen[own]
            back = (amount[:, None] * model.filters.T[kind]).reshape(-1, DIMENSIONS)
            flat = windows.ravel()
            grad_table = np.stack(
                [np.bincount(flat, back[:, d], PAD + 1) for d in range(DIMENSIONS)], axis=1
            ).astype(np.float32)
            grad_table[PAD] = 0
            for name, gradient in zip(names, (grad_table, grad_filters, flow.sum(0), grad_dense)):
                current = getattr(model, name)
                setattr(model, name, (current + steps[name](gradient + 1e-5 * current)).astype(np.float32))
            model.bias += float(step_bias(np.array([slope.sum()]))[0])
    return model


def fit(documents: DataFrame, labels: DataFrame, per_label: int = PER_LABEL, max_chars: int = TRAIN_CHARS) -> Model | None:
    """A model from a bounded sample of labelled documents outside the held-out fold; None if it lacks a label."""
    usable = labels.where(fold("doc_id", FOLDS) != HELD_OUT)
    texts, known = labelled_texts(documents, usable, "quality", per_label, max_chars)
    return train(texts, known) if len(set(known)) == 2 else None


def score(texts: pa.Array, model: Model | None) -> np.ndarray:
    """The probability of good quality of every whole text; 0.5 for all without a model."""
    if model is None:
        return np.full(len(texts), 0.5)
    data = pc.cast(filled(texts), pa.binary()).to_pylist()
    total, most = np.zeros((len(data), FILTERS)), np.zeros((len(data), FILTERS))
    counts = np.zeros(len(data))
    waiting, owners, held = [], [], 0

    def flush() -> None:
        nonlocal waiting, owners, held
        rows, owner = np.concatenate(waiting), np.concatenate(owners)
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        values = chunk_maxima(rows, model)
        np.add.at(total, owner[first], np.add.reduceat(values, first, axis=0))
        np.maximum.at(most, owner[first], np.maximum.reduceat(values, first, axis=0))
        np.add.at(counts, owner, 1)
        waiting, owners, held = [], [], 0

    for number, text in enumerate(data):
        rows = chunks_of(text)
        for at in range(0, len(rows), AT_ONCE):
            part = rows[at : at + AT_ONCE]
            waiting.append(part)
            owners.append(np.full(len(part), number))
            held += len(part)
            if held >= AT_ONCE:
                flush()
    if held:
        flush()
    shares = np.array([fill(text) for text in data]).reshape(-1, 1)
    pooled = np.hstack([total / np.maximum(counts, 1)[:, None], most, shares])
    return sigmoid(pooled @ model.dense + model.bias)


def predictor(model: Model | None) -> Callable[[Column | str], Column]:
    """A column function: text to the probability of good quality."""

    @F.arrow_udf("double")
    def predict(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in texts:
            batch = pa.RecordBatch.from_arrays([part], ["text"])
            found = [score(one.column("text"), model) for one in slices(batch, limit=SMALL_SLICE)]
            yield pa.array(np.concatenate(found) if found else np.zeros(0))

    return predict


def classify(documents: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id``, ``held_out``, ``score``, ``predicted`` of every document.

    A null text counts as empty and is scored as one padded chunk. Without a
    model (labels of one kind at most) every score is 0.5. Rows with null or
    repeated ids are kept; a null id is held out. Extra columns are not read.
    """
    return documents.select(
        "doc_id",
        (F.coalesce(fold("doc_id", FOLDS), F.lit(HELD_OUT)) == HELD_OUT).alias("held_out"),
        predictor(model)(F.col("text").cast("string")).alias("score"),
    ).withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))


def keep_good(documents: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """Documents of at least the given probability, with all their columns."""
    return documents.where(predictor(model)(F.col("text").cast("string")) >= threshold)
