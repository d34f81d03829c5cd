"""Words of a whole Arrow column of texts at once: byte classes, no loop over texts."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

from ordermill.llm.batches import filled

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32  # A-Z alone; bytes of longer UTF-8 sequences are all above 127
_LEAD = 0xC3  # first byte of U+00C0 to U+00FF


class Words(NamedTuple):
    codes: np.ndarray  # of every word, in text order, into ``names``
    names: pa.Array  # distinct words
    docs: np.ndarray  # row of every word
    pieces: np.ndarray  # equal for words of one row without a break between them


def byte_set(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


BLANKS = byte_set(b" \t\n\v\f\r")
_ASCII_LETTERS = byte_set(bytes(range(65, 91)) + bytes(range(97, 123)))


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The joined UTF-8 bytes of all rows, and the n + 1 offsets of the rows in them."""
    texts = filled(texts)
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    _, ends, data = texts.buffers()
    if not len(texts) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    offsets = np.frombuffer(ends, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def _cut(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, breaks: np.ndarray | None) -> Words:
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    rows = offsets[:-1][offsets[:-1] < len(data)]
    before[rows] = False  # a row's first byte never goes on with the row before
    starts = np.flatnonzero(inside & ~before)
    kept = np.cumsum(inside, dtype=np.int64)
    bounds = np.append(kept[starts] - 1, kept[-1] if len(kept) else 0).astype(np.int32)
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(data[inside]))
    coded = words.dictionary_encode()
    docs = np.searchsorted(offsets, starts, side="right") - 1
    cut = np.cumsum(breaks, dtype=np.int64)[starts] if breaks is not None else 0
    return Words(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary, docs, docs + cut)


def split_words(texts: pa.Array, blanks: np.ndarray = BLANKS, breaks: np.ndarray | None = None) -> Words:
    """Maximal runs without the bytes of ``blanks`` and ``breaks``, A-Z in lower case.

    Null texts have no words. ``blanks`` and ``breaks`` are sets of ASCII bytes.
    """
    raw, offsets = _bytes_of(texts)
    data = LOWER[raw]
    broken = breaks[data] if breaks is not None else None
    inside = ~blanks[data] if broken is None else ~(blanks[data] | broken)
    return _cut(data, offsets, inside, broken)


def split_letters(texts: pa.Array) -> Words:
    """Maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z in lower case."""
    raw, offsets = _bytes_of(texts)
    data = LOWER[raw]
    inside = _ASCII_LETTERS[data] | (data == _LEAD)
    inside[1:] |= data[:-1] == _LEAD
    return _cut(data, offsets, inside, None)


_KINDS = np.full(256, 2, np.uint8)  # 0: letters, 1: digits, 2: other marks
_KINDS[_ASCII_LETTERS] = 0
_KINDS[list(b"0123456789")] = 1
_ODD = byte_set(bytes(range(128, 256)) + bytes(range(32)) + b"'<\x7f")


def split_plain(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Codes of the parts of all texts, the distinct parts, and the n + 1 offsets of the texts in the codes.

    Words of plain ASCII are lower-cased and cut into runs of letters, single
    digits and runs of other marks. A word with any other byte, an apostrophe
    or a "<" is one part as it stands. Null texts have no parts.
    """
    raw, rows = _bytes_of(texts)
    inside = ~BLANKS[raw]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    filled_rows = rows[:-1][rows[:-1] < len(raw)]
    begins[filled_rows] = inside[filled_rows]
    data = raw[inside]
    kept = np.append(0, np.cumsum(inside, dtype=np.int64))
    words = kept[np.flatnonzero(begins)]  # where words start among the kept bytes
    lengths = np.diff(np.append(words, len(data)))
    odd_before = np.append(0, np.cumsum(_ODD[data], dtype=np.int64))
    plain = np.repeat(odd_before[words + lengths] == odd_before[words], lengths)
    kinds = _KINDS[data]
    cut = np.zeros(len(data), bool)
    cut[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == 1)
    cut &= plain
    cut[words] = True
    starts = np.flatnonzero(cut)
    lowered = np.where(plain, LOWER[data], data)
    bounds = np.append(starts, len(data)).astype(np.int32)
    coded = pa.StringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(lowered)).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary, np.searchsorted(starts, kept[rows])
