"""Packing of tokenised documents into sequences by order-preserving dynamic programming.

Documents keep their order and stay one stream of ids. The stream is cut into
windows of at most ``length`` ids. A cut behind a document costs nothing, one
behind a sentence ``SENTENCE_PENALTY``, behind any other id ``HARD_PENALTY``;
a window costs ``WINDOW_COST`` and the padding it needs. The cheapest cuts
are found over all ids of a block, with running minima over a quarter of the
length at once, in time linear in their number.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ordermill.llm.batches import MEMO_WORDS, slices
from ordermill.llm.tokens import WordTokens, with_end, word_tokens

LENGTH = 4096
END_ID = 2
SENTENCE_PENALTY = 8.0
HARD_PENALTY = 64.0
WINDOW_COST = 4.0
BLOCK_TOKENS = 1 << 19  # ids packed at once inside a task; bounds its memory
SENTENCE_MARKS = ".!?"
WIDE_MARKS = "。！？．｡…‽।॥؟۔።။។།"  # of two or three bytes each

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, sequence_length long, padding long, cut string, ids array<int>"
)
CUTS = ("document", "sentence", "inside")


def sentence_ids(library) -> np.ndarray:
    """True for each id whose token ends with a sentence mark."""
    flags = np.zeros(library.get_vocab_size(), bool)
    for token, number in library.get_vocab().items():
        flags[number] = token.removesuffix("</w>").endswith(tuple(SENTENCE_MARKS))
    return flags


def byte_tails(library) -> np.ndarray:
    """Of each id's token of a byte-level vocabulary the last three bytes, the last one lowest, and above them their number."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [byte for byte in range(256) if byte not in plain]
    value = {chr(byte): byte for byte in plain} | {chr(256 + at): byte for at, byte in enumerate(others)}
    tails = np.full(library.get_vocab_size(), 3 << 24, np.uint32)
    for token, number in library.get_vocab().items():
        text = token.removesuffix("</w>")
        if text and all(one in value for one in text):
            code = bytes(value[one] for one in text[-3:])
            tails[number] = len(code) << 24 | int.from_bytes(code)
    return tails


def padding(size: int, length: int) -> int:
    """A sequence is filled up to ``length``, except at a power of two."""
    return 0 if size & (size - 1) == 0 else length - size


def best_cuts(ends: np.ndarray, penalties: np.ndarray, length: int) -> list[int]:
    """The indexes of the chosen boundaries.

    ``ends``: rising positions of boundaries, at most ``length`` apart, the
    first one at most ``length``, the last one the end of the stream.
    Cost of a window from i to j: WINDOW_COST + length - (ends[j] - ends[i])
    + penalties[j], so the best i within reach is the least cost[i] + ends[i]:
    a sliding minimum. Windows of half or a quarter of the length need no
    padding either; where a boundary lies at exactly that distance it is
    tried too. Equal costs prefer the longest window.
    """
    charges = (penalties + WINDOW_COST).tolist()
    place = np.full(int(ends[-1]) + 1, -2, np.int64)
    place[ends], place[0] = np.arange(len(ends)), -1
    short = [place[np.maximum(ends - part, 0)] for part in (length // 2, length // 4)]
    short = [np.where(ends >= part, found, -2) for part, found in zip((length // 2, length // 4), short)]
    halves, quarters = (found.tolist() for found in short)
    cost, back = [0.0] * len(ends), [0] * len(ends)
    queue: deque[tuple[float, int, int]] = deque([(0.0, 0, -1)])  # cost + position, position, index
    for index, position in enumerate(ends.tolist()):
        while queue[0][1] < position - length:
            queue.popleft()
        total, _, source = queue[0]
        best = total + length - position
        for other in (halves[index], quarters[index]):
            if other > -2:
                value = cost[other] if other >= 0 else 0.0
                if value < best:
                    best, source = value, other
        best += charges[index]
        cost[index], back[index] = best, source
        total = best + position
        while queue and queue[-1][0] > total:
            queue.pop()
        queue.append((total, position, index))
    chosen, index = [], len(ends) - 1
    while index >= 0:
        chosen.append(index)
        index = back[index]
    return chosen[::-1]


def cheapest_cuts(penalties: np.ndarray, length: int) -> np.ndarray:
    """The chosen cuts of a stream that may be cut behind every id, of which ``penalties`` has one each.

    Costs are those of ``best_cuts``. Here a window never starts less than a
    quarter of the length before a position worth cutting at: to end the window before it
    later, a quarter before that position, saves three quarters of the length in
    padding. As long as no penalty exceeds that, the costs of a quarter of
    the length follow from those before it all at once.
    """
    count, part = len(penalties), length // 4
    if 3 * part <= penalties.max(initial=0.0):
        return np.array(best_cuts(np.arange(1, count + 1), penalties, length), np.int64) + 1
    # Place length + i belongs to position i; nothing lies before position 0.
    cost, reach = np.full(length + count + 1, np.inf), np.full(length + count + 1, np.inf)
    cost[length] = reach[length] = 0.0  # reach: cost + position
    for start in range(0, count, part):
        stop = min(start + part, count)
        position = np.arange(start + 1, stop + 1)
        near = reach[stop + 1 : start + length + 1].min()
        far = np.minimum.accumulate(reach[start + 1 : stop + 1][::-1])[::-1]
        best = np.minimum(far, near) + length - position
        for free in (length // 2, part):
            at = length - free
            best = np.minimum(best, cost[start + 1 + at : stop + 1 + at])
        best += penalties[start:stop] + WINDOW_COST
        cost[start + 1 + length : stop + 1 + length] = best
        reach[start + 1 + length : stop + 1 + length] = best + position
    chosen, position = [], count
    while position:
        chosen.append(position)
        window = reach[position : position + length]
        source = int(window.argmin())
        best, source = window[source] + length - position, position - length + source
        for free in (length // 2, part):
            if cost[position - free + length] < best:
                best, source = cost[position - free + length], position - free
        position = source
    return np.array(chosen[::-1], np.int64)


def mark_places(ids: np.ndarray, marks: np.ndarray, tails: np.ndarray | None) -> np.ndarray:
    """True for each id that ends a sentence; a mark's bytes may be spread over several ids."""
    found = marks[ids]
    if tails is None or not len(ids):
        return found
    own, sizes = (tails[ids] & 0xFFFFFF).astype(np.uint32), tails[ids] >> 24
    seen = own
    for _ in range(2):
        seen = own | (np.concatenate([[0], seen[:-1]]).astype(np.uint32) << (8 * sizes)) & 0xFFFFFF
    for mark in WIDE_MARKS:
        code = mark.encode()
        found = found | ((seen & ((1 << 8 * len(code)) - 1)) == int.from_bytes(code))
    return found


def tail_cuts(size: int, length: int) -> list[int]:
    """The last, short window of a block as powers of two, longest first: no padding."""
    if padding(size, length) == 0:
        return [size]
    return [1 << bit for bit in reversed(range(size.bit_length())) if size >> bit & 1]


class Block:
    """Ids of some documents in order; carries what the last window leaves over."""

    def __init__(self, marks: np.ndarray, length: int, tails: np.ndarray | None = None) -> None:
        self.marks, self.length, self.tails = marks, length, tails
        self.ids = np.zeros(0, np.uint32)
        self.docs: list[tuple] = []  # doc_id, its tokens, its ids before this block
        self.sequences = 0

    def add(self, doc_ids: list, ids: np.ndarray, offsets: np.ndarray) -> None:
        self.ids = np.concatenate([self.ids, ids])
        self.docs += [(doc, int(n), 0) for doc, n in zip(doc_ids, np.diff(offsets))]

    def pack(self, partition: int, final: bool) -> Iterator[tuple]:
        """Rows of all windows but the last one, which waits for what follows unless ``final``."""
        if not len(self.ids):
            return
        doc_ends = np.cumsum([n - before for _, n, before in self.docs])
        kinds = np.where(mark_places(self.ids, self.marks, self.tails), 1, 2)
        kinds[doc_ends - 1] = 0
        chosen = cheapest_cuts(np.array([0.0, SENTENCE_PENALTY, HARD_PENALTY])[kinds], self.length)
        cuts, kind = chosen.tolist(), kinds[chosen - 1].tolist()
        if final:
            start = cuts[-2] if len(cuts) > 1 else 0
            tail = np.cumsum(tail_cuts(cuts[-1] - start, self.length)) + start
            cuts = cuts[:-1] + tail.tolist()
            kind = kind[:-1] + kinds[tail - 1].tolist()
        else:
            cuts, kind = cuts[:-1], kind[:-1]
        start, doc, doc_start = 0, 0, 0
        for cut, why in zip(cuts, kind):
            number = (partition << 33) + self.sequences
            self.sequences += 1
            at = start
            while at < cut:
                doc_id, tokens, before = self.docs[doc]
                stop = min(cut, int(doc_ends[doc]))
                if stop > at:
                    yield (
                        doc_id, before + at - doc_start, tokens, number, at - start,
                        cut - start, padding(cut - start, self.length), CUTS[why], self.ids[at:stop],
                    )
                at = stop
                if stop == doc_ends[doc]:
                    doc, doc_start = doc + 1, stop
            start = cut
        rest = self.docs[doc:]
        if rest:
            doc_id, tokens, before = rest[0]
            rest[0] = (doc_id, tokens, before + start - doc_start)
        self.ids, self.docs = self.ids[start:], rest


def _table(rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    import zlib

    doc, start, tokens, number, offset, size, pad, cut, ids = zip(*rows)
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": pa.array(doc, pa.int64()),
            "start": pa.array(start, pa.int64()),
            "length": pa.array([len(one) for one in ids], pa.int64()),
            "ids_crc32": pa.array([zlib.crc32(one.astype("<u4").tobytes()) for one in ids], pa.int64()),
            "doc_tokens": pa.array(tokens, pa.int64()),
            "sequence_id": pa.array(number, pa.int64()),
            "offset": pa.array(offset, pa.int64()),
            "sequence_length": pa.array(size, pa.int64()),
            "padding": pa.array(pad, pa.int64()),
            "cut": pa.array(cut, pa.string()),
            "ids": pa.array([one.astype(np.int32) if with_ids else None for one in ids], pa.list_(pa.int32())),
        }
    )


def pack(
    documents: DataFrame,
    tokenizer: str,
    length: int = LENGTH,
    end_id: int = END_ID,
    with_ids: bool = True,
    memo_words: int = MEMO_WORDS,
) -> DataFrame:
    """One row per piece of a document in a sequence, with the ids it holds.

    Order is that of the rows inside each partition of ``documents``; nothing
    is shuffled, so sort by range before where another order is asked for.
    Each partition is packed by itself in blocks of about ``BLOCK_TOKENS``;
    the window left open at a block's end is carried into the next block,
    and a partition's last window is cut into powers of two, which need no
    padding. ``sequence_id`` = partition number * 2**33 + number in it.

    ``memo_words``: words each worker remembers, time against memory.

    Only ``doc_id`` and ``text`` are read. A null text counts as empty: such
    a document is its end id alone. Null, repeated or tied ids are kept as
    they are, a piece each. An empty table gives no rows. A document is cut
    at a sentence's end or inside a sentence where that costs less than the
    padding it saves.
    """
    if length < 2 or length & (length - 1):
        raise ValueError("length must be a power of two")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder: WordTokens = word_tokens(tokenizer, memo_words)
        block = Block(sentence_ids(encoder.library), length, byte_tails(encoder.library))
        partition = TaskContext.get().partitionId()

        def flush(final: bool) -> Iterator[pa.RecordBatch]:
            rows = list(block.pack(partition, final))
            for at in range(0, len(rows), 20_000):
                yield _table(rows[at : at + 20_000], with_ids)

        for batch in batches:
            for part in slices(batch):
                ids, offsets = with_end(*encoder(part.column("text")), end_id)
                block.add(part.column("doc_id").to_pylist(), ids, offsets)
                if len(block.ids) >= BLOCK_TOKENS:
                    yield from flush(False)
        yield from flush(True)

    narrow = documents.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    return narrow.mapInArrow(work, SCHEMA)
