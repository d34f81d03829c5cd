"""Whole texts to ids of a word-level tokenizer, one Arrow slice at a time."""

from __future__ import annotations

import functools
import os
import re

import numpy as np
import pyarrow as pa

from ordermill.llm.batches import MEMO_WORDS, Memo, encode_codes, give_back
from ordermill.llm.spans import split_plain


PART_END = "</w>"  # mark of the pieces that end a part, in vocabularies that have one
TOGETHER = 256
_PLAIN = re.compile(r"[a-z]+|[0-9]|[!-&(-/:;=-@\[-`{-~]+")  # what split_plain cuts out of plain words


class WordTokens:
    """Ids as the tokenizers library gives for whole texts, without special tokens added.

    For tokenizers that lower-case, drop white space and cut runs of letters,
    single digits and runs of other marks apart: no id spans two of them.
    Words of plain ASCII are cut in that way for a whole slice at once, and
    each distinct part is encoded by the library once. Words that normalising,
    contractions or special tokens may concern are left to the library whole;
    normalisation never joins a blank with what stands next to it.
    """

    def __init__(self, path: str, memo_words: int = MEMO_WORDS) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.memo = Memo(self._encode, memo_words)
        known = self.library.get_vocab()
        self.ends = np.zeros(max(known.values()) + 1, bool)  # ids that end a part
        self.ends[[number for piece, number in known.items() if piece.endswith(PART_END)]] = True

    def _one_by_one(self, words: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(words, add_special_tokens=False)
        return [np.asarray(one.ids, np.uint32).tobytes() for one in found]

    def _joined(self, words: list[str]) -> list[bytes]:
        """Ids of plain parts, many to a text: the last id of a part, and no other, ends it."""
        texts = [" ".join(words[at : at + TOGETHER]) for at in range(0, len(words), TOGETHER)]
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.concatenate([np.asarray(one.ids, np.uint32) for one in found])
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(words) or ends[-1] != len(ids):  # a vocabulary without ends of parts
            return self._one_by_one(words)
        data, cuts = ids.tobytes(), [0, *(ends * ids.itemsize).tolist()]
        return [data[a:b] for a, b in zip(cuts, cuts[1:])]

    def _encode(self, words: list[str]) -> list[bytes]:
        plain = [word for word in words if _PLAIN.fullmatch(word)]
        known = dict(zip(plain, self._joined(plain))) if plain else {}
        others = [word for word in words if word not in known]
        known |= zip(others, self._one_by_one(others)) if others else ()
        return [known[word] for word in words]

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        give_back()
        codes, names, offsets = split_plain(texts)
        return encode_codes(codes, names.to_pylist(), offsets, self.memo, np.uint32)


@functools.cache
def word_tokens(path: str, memo_words: int = MEMO_WORDS) -> WordTokens:
    """One per worker process, so that its memo outlives a task."""
    return WordTokens(path, memo_words)


def with_end(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Every text followed by ``end_id``."""
    count = len(offsets) - 1
    return np.insert(ids, offsets[1:], end_id), offsets + np.arange(count + 1)
