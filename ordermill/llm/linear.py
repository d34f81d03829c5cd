"""Linear models over hashed n-grams of letters, taken at every letter of whole texts."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ordermill.llm.batches import filled

STEP = 1 << 18  # letters scored at once; bounds memory, a text may be longer
_ODD = [int(x) | 1 for x in np.random.default_rng(11).integers(1 << 31, 1 << 32, 16, dtype=np.uint64)]


@functools.cache
def _letters() -> np.ndarray:
    """True for each code point that is a letter."""
    return np.fromiter((chr(point).isalpha() for point in range(0x110000)), bool, 0x110000)


def code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points of all texts joined, a blank behind each, and the n + 1 offsets."""
    lower = pc.utf8_lower(filled(texts))
    lengths = pc.utf8_length(lower).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    joined = "".join(text + " " for text in lower.to_pylist())
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32), np.concatenate([[0], np.cumsum(lengths)])


def letter_grams(points: np.ndarray, sizes: tuple[int, ...], table: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of letters, and for each the hashed places of the n-grams that end there (one column per n).

    What lies before the word counts as blank, so the first n - 1 letters
    of a word give grams that mark its beginning. ``table``: a power of two.
    """
    is_letter = _letters()[points]
    at = np.flatnonzero(is_letter)
    blank = np.maximum.accumulate(np.where(is_letter, -1, np.arange(len(points))))[at]
    inside = at - blank  # 1 for a word's first letter
    places = np.empty((len(at), len(sizes)), np.int32)
    with np.errstate(over="ignore"):
        rolled = np.zeros(len(at), np.uint32)
        column = 0
        for back in range(max(sizes)):
            code = points[np.maximum(at - back, 0)]
            rolled = rolled + np.where(inside > back, code + np.uint32(1), np.uint32(0)) * np.uint32(_ODD[back])
            if back + 1 in sizes:
                mixed = (rolled ^ (rolled >> np.uint32(15))) * np.uint32(_ODD[12]) + np.uint32(back)
                places[:, column] = (mixed ^ (mixed >> np.uint32(13))) & np.uint32(table - 1)
                column += 1
    return at, places


def steps(points: np.ndarray, overlap: int = 16) -> Iterator[tuple[int, int, int]]:
    """Ranges of about ``STEP`` points with what must be seen before them: (seen from, start, stop)."""
    for start in range(0, len(points), STEP):
        yield max(0, start - overlap), start, min(len(points), start + STEP)


def summed(points: np.ndarray, owner_starts: np.ndarray, sizes: tuple[int, ...], weights: np.ndarray) -> np.ndarray:
    """Per owner (a range of points): summed weights of all grams, and in the last column their letters."""
    owners = len(owner_starts)
    width = weights.shape[1]
    totals = np.zeros((owners, width + 1))
    for seen, start, stop in steps(points):
        at, places = letter_grams(points[seen:stop], sizes, len(weights))
        new = at >= start - seen
        at, places = at[new] + seen, places[new]
        if not len(at):
            continue
        owner = np.searchsorted(owner_starts, at, side="right") - 1
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        values = weights[places[:, 0]]
        for column in range(1, places.shape[1]):
            values = values + weights[places[:, column]]
        totals[owner[first], :width] += np.add.reduceat(values, first, axis=0, dtype=np.float64)
        totals[owner[first], width] += np.diff(np.append(first, len(at)))
    return totals


class Adam:
    """Steps for one array of weights."""

    def __init__(self, shape: tuple[int, ...] | int, rate: float) -> None:
        self.rate, self.step = rate, 0
        self.mean, self.square = np.zeros(shape, np.float32), np.zeros(shape, np.float32)

    def __call__(self, gradient: np.ndarray) -> np.ndarray:
        self.step += 1
        self.mean += 0.1 * (gradient - self.mean)
        self.square += 0.001 * (gradient * gradient - self.square)
        mean = self.mean / (1 - 0.9**self.step)
        square = self.square / (1 - 0.999**self.step)
        return -self.rate * mean / (np.sqrt(square) + 1e-8)


def sigmoid(values: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(values, -60, 60)))
