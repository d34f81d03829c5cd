"""SentencePiece encoding by a table of every prefix's last token, and decoding.

The merges of a BPE model give every text one encoding. A sequence of
pieces is that encoding exactly if each two neighbours are compatible: if
merging the text of just these two gives the same two. So the encoding of a
prefix ends with the one piece that ends there and is compatible with the
last piece of the prefix before it. An automaton finds all pieces that end
at a place, the table keeps the one that fits, and the ids are read
backwards from the end of the table.

Pieces hold a blank (written as a lower block) only in front, so words with
the blank before them are encoded apart from each other.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ordermill.llm.batches import Memo, encode_codes, filled, slices

BLANK = "▁"
_CHUNK = re.compile(f"{BLANK}+[^{BLANK}]*")
LATE = -1e8  # pieces of a score below are merged after all others: runs of blanks
SCHEMA = "doc_id long, n_tokens long, ids array<int>, decoded string, ids_sha256 string, decoded_sha256 string"


class PieceTable:
    """Encoder and decoder of one model; equal to the sentencepiece library, as tests hold."""

    def __init__(self, path: str) -> None:
        import ahocorasick
        from sentencepiece import SentencePieceProcessor

        library = SentencePieceProcessor(model_file=path)
        size = library.get_piece_size()
        special = [library.is_control(i) or library.is_unknown(i) or library.is_byte(i) or library.is_unused(i) for i in range(size)]
        pieces = {library.id_to_piece(i): i for i in range(size) if not special[i]}
        self.end_id = library.eos_id()
        self.byte_ids = [library.piece_to_id(f"<0x{byte:02X}>") for byte in range(256)]
        self.blank_id = pieces[BLANK]
        self.runs = {len(piece): i for piece, i in pieces.items() if piece.strip(BLANK) == ""}
        words = {p: i for p, i in pieces.items() if len(p) == 1 or library.get_score(i) > LATE}
        if any(BLANK in piece[1:] for piece in words) or not {c for p in words for c in p} <= words.keys():
            raise ValueError("pieces must hold blanks only in front, and letters that are pieces too")
        self.text = {i: piece for piece, i in words.items()}
        by_score = sorted((p for p in words if len(p) > 1), key=lambda piece: -library.get_score(words[piece]))
        self.rank = {words[piece]: place + 1 for place, piece in enumerate(by_score)}  # single letters: 0
        self.joined = {
            (words[piece[:cut]], words[piece[cut:]]): words[piece]
            for piece in by_score
            for cut in range(1, len(piece))
            if piece[:cut] in words and piece[cut:] in words
        }
        self.parts: dict[int, tuple[int, int]] = {}
        self.ordered: set[int] = set()  # pieces whose parts were all merged before them
        self.automaton = ahocorasick.Automaton()
        for piece in [p for p in words if len(p) == 1] + by_score:
            number = words[piece]
            if len(piece) > 1:
                last = self._merge([words[letter] for letter in piece])
                if last is None:
                    continue  # never made by merges, so never in an encoding
                self.parts[number] = last
            if all(self.rank.get(part, 0) < self.rank.get(number, 1) and part in self.ordered for part in self.parts.get(number, ())):
                self.ordered.add(number)
            self.automaton.add_word(piece, (len(piece), number))
        self.automaton.make_automaton()
        self.left = {number: self._spine(number, 0) for number in self.text}
        self.right = {number: self._spine(number, 1) for number in self.text}
        self.fits: dict[tuple[int, int], bool] = {}
        self.memo = Memo(lambda chunks: [np.array(self.chunk_ids(c), np.uint32).tobytes() for c in chunks])
        self.surface = [b""] * size
        for piece, number in pieces.items():
            self.surface[number] = piece.replace(BLANK, " ").encode()
        for byte, number in enumerate(self.byte_ids):
            self.surface[number] = bytes([byte])
        self.decimal = [str(number) for number in range(size)]

    def _merge(self, ids: list[int], full: bool = False):
        """Merge by rank, leftmost first: the two parts joined last (None if more than one is left), or all that is left."""
        last = None
        while len(ids) > 1:
            best = min(
                ((self.rank[made], at) for at in range(len(ids) - 1) if (made := self.joined.get((ids[at], ids[at + 1])))),
                default=None,
            )
            if best is None:
                break
            at = best[1]
            last = (ids[at], ids[at + 1])
            ids = [*ids[:at], self.joined[last], *ids[at + 2 :]]
        if full:
            return ids
        return last if len(ids) == 1 else None

    def _spine(self, number: int, side: int) -> list[tuple[int, int, float]]:
        """The piece and its outer parts on one side: (piece, its rank, rank of what it is merged into)."""
        steps, into = [], float("inf")
        while True:
            steps.append((number, self.rank.get(number, 0), into))
            if number not in self.parts:
                return steps
            into = self.rank[number]
            number = self.parts[number][side]

    def compatible(self, first: int, second: int) -> bool:
        """True if the two pieces next to each other stay apart when their text is merged.

        They do not if some outer part x of the first and y of the second
        stood side by side at some time (each is made before the other is
        merged on) and joining them ranked before what x and y were merged
        into. Equal ranks go to the left. Pieces with parts of a later rank
        than their own are put to the test itself.
        """
        known = self.fits.get((first, second))
        if known is None:
            if first in self.ordered and second in self.ordered:
                known = not any(
                    (made := self.joined.get((x, y)))
                    and self.rank[made] < x_into
                    and self.rank[made] <= y_into
                    and y_rank < x_into
                    and x_rank <= y_into
                    for x, x_rank, x_into in self.right[first]
                    for y, y_rank, y_into in self.left[second]
                )
            else:
                letters = self.text[first] + self.text[second]
                known = self._merge([self._letter(c) for c in letters], full=True) == [first, second]
            if len(self.fits) > 2_000_000:
                self.fits = {}
            self.fits[first, second] = known
        return known

    def _letter(self, letter: str) -> int:
        return self.automaton.get(letter)[1]

    def _blank_run(self, count: int) -> list[int]:
        """Blanks that no word took: joined from the left as long as a longer run is a piece."""
        sizes: list[int] = []  # no two neighbours can be joined
        for _ in range(count):
            if sizes and sizes[-1] + 1 in self.runs:
                sizes[-1] += 1
                while len(sizes) > 1 and sizes[-2] + sizes[-1] in self.runs:
                    last = sizes.pop()
                    sizes[-1] += last
            else:
                sizes.append(1)
        return [self.blank_id if size == 1 else self.runs[size] for size in sizes]

    def word_ids(self, word: str) -> list[int]:
        """Ids of a word with at most one blank in front. A letter without a piece becomes its bytes."""
        last: list[tuple[int, int] | None] = [None] * (len(word) + 1)  # (length, piece) that ends a prefix
        open_end = 0  # prefixes up to here are done
        for end, (length, number) in self.automaton.iter(word):
            end += 1
            while open_end < end - 1:
                open_end += 1
                if last[open_end] is None:
                    last[open_end] = (1, -1)
            if last[end] is not None:
                continue
            before = last[end - length] if end > length else None
            if end == length or (before is not None and (before[1] < 0 or self.compatible(before[1], number))):
                last[end] = (length, number)
            open_end = max(open_end, end - 1)
        ids: list[int] = []
        at = len(word)
        while at:
            length, number = last[at] or (1, -1)
            if number >= 0:
                ids.append(number)
            else:
                ids += [self.byte_ids[byte] for byte in reversed(word[at - 1].encode())]
            at -= length
        return ids[::-1]

    def chunk_ids(self, chunk: str) -> list[int]:
        """Ids of blanks and the word behind them; the word's merges come first and may take one blank."""
        word = chunk.lstrip(BLANK)
        blanks = len(chunk) - len(word)
        if not word:
            return self._blank_run(blanks)
        ids = self.word_ids(BLANK + word)
        if blanks == 1:
            return ids
        if ids[0] == self.blank_id:
            return self._blank_run(blanks) + ids[1:]
        return self._blank_run(blanks - 1) + ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts joined, each with the end id, and the n + 1 offsets."""
        table: dict[str, int] = {}
        codes, counts = [], []
        for text in filled(texts).to_pylist():
            chunks = _CHUNK.findall(BLANK + text.replace(" ", BLANK)) if text else []
            codes += [table.setdefault(chunk, len(table)) for chunk in chunks]
            counts.append(len(chunks))
        offsets = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        ids, offsets = encode_codes(np.array(codes, np.int64), list(table), offsets, self.memo, np.uint32)
        return np.insert(ids, offsets[1:], self.end_id), offsets + np.arange(len(offsets))

    def decode(self, ids: list[int]) -> str:
        """Text of ids: pieces side by side, blanks for blocks, the first blank dropped; bytes that are no text: U+FFFD."""
        joined = b"".join(map(self.surface.__getitem__, ids))
        text = joined.removeprefix(b" ")
        try:
            return text.decode()
        except UnicodeDecodeError:
            return text.decode(errors="replace")


@functools.cache
def piece_table(path: str) -> PieceTable:
    """One per worker process, so that its memo outlives a task."""
    return PieceTable(path)


def encode_decode(documents: DataFrame, model: str, with_values: bool = True) -> DataFrame:
    """Ids (with the end id), the text decoded from them and digests of both, of every whole text.

    A null text counts as empty: the end id alone, decoded to an empty text.
    Rows with null or repeated ids are kept. ``with_values``: false leaves
    ``ids`` and ``decoded`` null. Only ``doc_id`` and ``text`` are read.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = piece_table(model)
        for batch in batches:
            for part in slices(batch):
                ids, offsets = table.encode(part.column("text"))
                numbers, ends = ids.tolist(), offsets.tolist()
                own = [numbers[a:b] for a, b in zip(ends, ends[1:])]
                decoded = [table.decode(one) for one in own]
                decimals = [" ".join(map(table.decimal.__getitem__, one)) for one in own]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part.column("doc_id"),
                        "n_tokens": pa.array(np.diff(offsets)),
                        "ids": pa.array(own if with_values else [None] * len(own), pa.list_(pa.int32())),
                        "decoded": pa.array(decoded if with_values else [None] * len(own), pa.string()),
                        "ids_sha256": pa.array([hashlib.sha256(one.encode()).hexdigest() for one in decimals]),
                        "decoded_sha256": pa.array([hashlib.sha256(one.encode()).hexdigest() for one in decoded]),
                    }
                )

    narrow = documents.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    return narrow.mapInArrow(work, SCHEMA)
