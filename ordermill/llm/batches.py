"""Helpers for Arrow batches of texts inside Spark tasks: slices, word tables, memoised encoders."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 8 << 20  # text handled at once inside a task; bounds memory, never the rows
SMALL_SLICE = 2 << 20  # the same where every letter takes room of its own
MEMO_WORDS = 400_000  # words remembered per generation; a word beyond it is encoded again


def filled(texts: pa.Array) -> pa.Array:
    """Null texts as empty ones."""
    return pc.fill_null(texts.cast(pa.string()), "")


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive row ranges of about ``limit`` bytes of text; one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def give_back() -> None:
    """Hand memory that this worker has freed, also in earlier stages, back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        pass


def list_parts(lists: pa.ListArray) -> tuple[pa.Array, np.ndarray]:
    """The values of a list array without nulls, and its n + 1 offsets from zero."""
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    return lists.flatten(), np.concatenate([[0], np.cumsum(lengths)])


def word_table(values: pa.Array) -> tuple[np.ndarray, list[str]]:
    """Each value's code, and the distinct values by code."""
    if not len(values):
        return np.zeros(0, np.int64), []
    encoded = values.dictionary_encode()
    return encoded.indices.to_numpy().astype(np.int64), encoded.dictionary.to_pylist()


def gather_spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of every span, one span after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - ends + lengths, lengths) + np.arange(total)


class Memo:
    """Remembers what ``encode`` returned for a word, as bytes.

    Two generations of at most ``limit`` words each: a full young one
    replaces the old one, and a word found in the old one moves to the young
    one, so frequent words stay. Only time depends on what is remembered.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]], limit: int = MEMO_WORDS) -> None:
        self.encode, self.limit, self.young, self.old = encode, limit, {}, {}

    def __call__(self, words: list[str]) -> list[bytes]:
        if len(self.young) > self.limit:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        missing = [word for word in words if word not in young]
        if old:
            young.update((word, old[word]) for word in missing if word in old)
            missing = [word for word in missing if word not in young]
        if missing:
            young.update(zip(missing, self.encode(missing)))
        return [young[word] for word in words]


def encode_codes(
    codes: np.ndarray, words: list[str], offsets: np.ndarray, memo: Memo, kind: type
) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words of all texts joined, and the n + 1 offsets of the texts in them."""
    parts = memo(words)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts)) // np.dtype(kind).itemsize
    flat = np.frombuffer(b"".join(parts), kind)
    starts = np.cumsum(lengths) - lengths
    per_word = lengths[codes]
    ids = flat[gather_spans(starts[codes], per_word)] if len(codes) else flat[:0]
    return ids, np.concatenate([[0], np.cumsum(per_word)])[offsets]


def encode_lists(lists: pa.ListArray, memo: Memo, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """``encode_codes`` of a list of words per text."""
    values, offsets = list_parts(lists)
    codes, words = word_table(values)
    return encode_codes(codes, words, offsets, memo, kind)
