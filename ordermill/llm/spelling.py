"""Spelling variants: words one edit apart, found in a trie of letter-group counts.

Every word becomes a vector: how many of its letters fall into each of 16
groups. One inserted, deleted or replaced letter raises at most one count by
one and lowers at most one by one, so a depth-first search of the trie of
vectors that may spend one surplus and one deficit meets all near words; the
words at the leaves it reaches are then verified letter by letter.

The trie is spread over tasks by its own shape: nodes that hold more than
``LIMIT`` words are open, and the subtrees below open nodes are the units of
work. Only the open nodes (at most ``GROUPS * words / LIMIT``) are known to
all tasks; a word walks them once to find its own subtree and all subtrees
its budget reaches. Of two near words only one searches: the one with more
letters, or the one whose vector is greater; words of equal vectors both do.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.batches import slices
from ordermill.llm.spans import split_letters
from ordermill.sources.scratch import materialize

GROUPS = 16
LIMIT = 8192  # words of a subtree
MIN_LETTERS = 6
MIN_COUNT = 5
FORM_RATIO = 5
DELETE_MOD = 199
PAIRS = 1 << 16  # vectors compared at once at the leaves
MATRIX_LETTERS = 48  # longer words are verified one by one

# Letters with a group of their own, by how often they occur; the rest share seven groups.
_OWN = "etaoinshr"


def _group_table() -> np.ndarray:
    table = np.arange(0x250, dtype=np.int64) % (GROUPS - len(_OWN)) + len(_OWN)
    for place, letter in enumerate(_OWN):
        table[ord(letter)] = place
    return table


_TABLE = _group_table()
_ORDER = 1 << np.arange(GROUPS, dtype=np.int32)[::-1]  # the sum's sign is that of the first of two differences


def letters_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words joined, and the length of every word."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    return points, np.fromiter(map(len, words), np.int64, len(words))


def vectors(words: list[str]) -> np.ndarray:
    """Letter-group counts, one row of ``GROUPS`` bytes a word; counts above 255 count as 255.

    Cutting counts off never makes a difference larger, so no near word is missed.
    """
    points, lengths = letters_of(words)
    groups = np.where(points < len(_TABLE), _TABLE[np.minimum(points, len(_TABLE) - 1)], points % GROUPS)
    flat = np.repeat(np.arange(len(words)), lengths) * GROUPS + groups
    counts = np.bincount(flat, minlength=len(words) * GROUPS)
    return np.minimum(counts, 255).astype(np.uint8).reshape(-1, GROUPS)


# Counting ----------------------------------------------------------------------


def _deleted(name: str, number: int) -> str:
    at = number % len(name)
    return name[:at] + name[at + 1 :]


def run_counts(documents: DataFrame, delete_mod: int = DELETE_MOD, min_letters: int = MIN_LETTERS) -> DataFrame:
    """``word``, ``n``: occurrences over all texts of every run of at least ``min_letters`` letters.

    A run whose hash (crc32 of ``<doc_id>:<run>``) is divisible by
    ``delete_mod`` first loses the letter at hash modulo length. A null id
    is written as an empty one; null texts have no runs; rows with equal ids
    count each.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = split_letters(part.column("text"))
                lengths = pc.utf8_length(found.names).to_numpy(zero_copy_only=False)
                used = lengths[found.codes] >= min_letters
                codes, docs = found.codes[used], found.docs[used]
                names = pc.cast(found.names, pa.binary()).to_pylist()
                seeds = [zlib.crc32(f"{one}:".encode()) for one in pc.fill_null(part.column("doc_id"), "").to_pylist()]
                runs = map(names.__getitem__, codes.tolist())
                hashes = np.fromiter(map(zlib.crc32, runs, map(seeds.__getitem__, docs.tolist())), np.int64, len(codes))
                hit = hashes % delete_mod == 0
                counts = np.bincount(codes[~hit], minlength=len(names))
                whole = np.flatnonzero(counts)
                shorter = Counter(
                    _deleted(names[code].decode(), number) for code, number in zip(codes[hit].tolist(), hashes[hit].tolist())
                )
                shorter = {word: n for word, n in shorter.items() if len(word) >= min_letters}
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([found.names.take(pa.array(whole)), pa.array(list(shorter), pa.string())]),
                        pa.array(np.concatenate([counts[whole], np.fromiter(shorter.values(), np.int64, len(shorter))]), pa.int64()),
                    ],
                    ["word", "n"],
                )

    narrow = documents.selectExpr("cast(doc_id as string) doc_id", "cast(text as string) text")
    return narrow.mapInArrow(work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


# The trie over tasks -------------------------------------------------------------


def _with_vectors(words: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = vectors(batch.column("word").to_pylist())
            column = pa.FixedSizeBinaryArray.from_buffers(pa.binary(GROUPS), len(made), [None, pa.py_buffer(made.tobytes())])
            yield batch.append_column("vec", column.cast(pa.binary()))

    return words.select("word", "n").mapInArrow(work, "word string, n long, vec binary")


def open_nodes(words: DataFrame, limit: int) -> dict[bytes, int]:
    """Prefixes of vectors that more than ``limit`` words share, with their counts."""
    depths = F.explode(F.sequence(F.lit(0), F.lit(GROUPS))).alias("depth")
    counted = words.groupBy("vec").agg(F.count(F.lit(1)).alias("n"))
    prefixes = counted.select(F.col("vec"), "n", depths).select(F.expr("substring(vec, 1, depth)").alias("node"), "n")
    rows = prefixes.groupBy("node").agg(F.sum("n").alias("n")).where(F.col("n") > limit).collect()
    return {bytes(row["node"]): row["n"] for row in rows}


def own_subtree(vec: bytes, opened: dict[bytes, int]) -> bytes:
    depth = 0
    while depth < GROUPS and vec[:depth] in opened:
        depth += 1
    return vec[:depth]


def reached_subtrees(vec: bytes, opened: dict[bytes, int]) -> list[bytes]:
    """Subtrees that may hold a near word which this one has to find: the first difference is a deficit."""
    found, todo = [], [(b"", False, False)]
    while todo:
        node, deficit, surplus = todo.pop()
        depth = len(node)
        if depth == GROUPS or node not in opened:
            found.append(node)
            continue
        count = vec[depth]
        todo.append((node + bytes([count]), deficit, surplus))
        if count and not deficit:
            todo.append((node + bytes([count - 1]), True, surplus))
        if count < 255 and deficit and not surplus:
            todo.append((node + bytes([count + 1]), deficit, True))
    return found


def _dealt(words: DataFrame, opened: dict[bytes, int], limit: int, searching: bool) -> DataFrame:
    """Rows with the subtree (``node``) and its block; a leaf beyond the limit has several blocks."""

    def blocks(node: bytes) -> int:
        return -(-opened.get(node, 0) // limit) if len(node) == GROUPS else 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[bytes, list[bytes]] = {}
        for batch in batches:
            rows, nodes, parts = [], [], []
            names = batch.column("word").to_pylist()
            for row, vec in enumerate(batch.column("vec").to_pylist()):
                if vec not in memo:
                    if len(memo) > 50_000:
                        memo.clear()
                    memo[vec] = reached_subtrees(vec, opened) if searching else [own_subtree(vec, opened)]
                for node in memo[vec]:
                    count = max(1, blocks(node))
                    own = [zlib.crc32(names[row].encode()) % count] if not searching else range(count)
                    for one in own:
                        rows.append(row)
                        nodes.append(node)
                        parts.append(one)
            yield pa.RecordBatch.from_arrays(
                [*batch.take(pa.array(rows, pa.int64())).columns, pa.array(nodes, pa.binary()), pa.array(parts, pa.int32())],
                ["word", "n", "vec", "node", "block"],
            )

    return words.mapInArrow(work, "word string, n long, vec binary, node binary, block int")


# Search inside a subtree -----------------------------------------------------------


def candidates(stored: np.ndarray, probes: np.ndarray, depth: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (probe, stored) of rows within the budget; ``stored`` is sorted and shares its first ``depth`` counts.

    The search walks the trie depth first with all probes that still can pay
    at a node; small nodes are compared directly.
    """
    if not len(stored) or not len(probes):
        return
    stored, probes = stored.astype(np.int16), probes.astype(np.int16)
    top = stored[0, :depth] - probes[:, :depth]
    budget = (top == 0).all(1) | ((np.abs(top) <= 1).all(1) & ((top == -1).sum(1) == 1) & ((top == 1).sum(1) <= 1))
    first = np.flatnonzero(budget)
    deficit, surplus = (top[first] == -1).any(1), (top[first] == 1).any(1)
    todo = [(0, len(stored), depth, first, deficit, surplus)]
    while todo:
        low, high, level, idx, deficit, surplus = todo.pop()
        if level == GROUPS or (high - low) * len(idx) <= PAIRS // GROUPS:
            step = max(1, PAIRS // (high - low))
            for at in range(0, len(idx), step):
                some = slice(at, at + step)
                rest = stored[None, low:high, level:] - probes[idx[some], None, level:]
                minus, plus = (rest == -1).sum(2) + deficit[some, None], (rest == 1).sum(2) + surplus[some, None]
                right = (np.abs(rest) <= 1).all(2) & (minus <= 1) & (plus <= minus)
                right &= deficit[some, None] | (rest @ _ORDER[level:] <= 0)  # the first difference is a deficit
                a, b = np.nonzero(right)
                yield idx[some][a], b + low
            continue
        column = stored[low:high, level]
        cuts = np.flatnonzero(np.diff(column)) + 1
        bounds = [0, *cuts.tolist(), high - low]
        own = probes[idx, level]
        for begin, end in zip(bounds[:-1], bounds[1:]):
            change = column[begin] - own
            down, up = (change == -1) & ~deficit, (change == 1) & deficit & ~surplus
            keep = np.flatnonzero((change == 0) | down | up)
            if len(keep):
                todo.append((low + begin, low + end, level + 1, idx[keep], (deficit | down)[keep], (surplus | up)[keep]))


def one_edit(a: str, b: str) -> bool:
    """Exactly one inserted, deleted or replaced code point."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    short = min(len(a), len(b))
    head = next((i for i in range(short) if a[i] != b[i]), short)
    tail = next((i for i in range(short) if a[-1 - i] != b[-1 - i]), short)
    return head + tail >= max(len(a), len(b)) - 1


class _Letters:
    """Words as two matrices of code points, aligned left and right."""

    def __init__(self, words: list[str]) -> None:
        points, self.lengths = letters_of([word[: MATRIX_LETTERS + 1] for word in words])
        width = int(self.lengths.max()) if len(words) else 0
        self.left, self.right = (np.zeros((len(words), width), np.uint32) for _ in range(2))
        row = np.repeat(np.arange(len(words)), self.lengths)
        column = np.arange(len(points)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        self.left[row, column] = points
        self.right[row, column + (width - self.lengths)[row]] = points


def verified(words: list[str], a: np.ndarray, b: np.ndarray, letters: _Letters) -> np.ndarray:
    """Which pairs of words are one edit apart."""
    result = np.zeros(len(a), bool)
    longest = np.maximum(letters.lengths[a], letters.lengths[b])
    slow = np.flatnonzero(longest > MATRIX_LETTERS)
    fast = np.flatnonzero(longest <= MATRIX_LETTERS)
    for at in range(0, len(fast), PAIRS):
        some = fast[at : at + PAIRS]
        x, y = a[some], b[some]
        head = letters.left[x] != letters.left[y]
        tail = (letters.right[x] != letters.right[y])[:, ::-1]
        width = head.shape[1]
        first = np.where(head.any(1), head.argmax(1), width)
        last = np.where(tail.any(1), tail.argmax(1), width)
        differ = head.any(1) & (np.abs(letters.lengths[x] - letters.lengths[y]) <= 1)
        result[some] = differ & (first + last >= longest[some] - 1)
    for at in slow.tolist():
        result[at] = one_edit(words[a[at]], words[b[at]])
    return result


def near_in_subtree(
    stored: list[str], stored_n: np.ndarray, probes: list[str], probe_n: np.ndarray, depth: int
) -> tuple[list[str], np.ndarray, np.ndarray, list[str]]:
    """For every word with near words here: word, how many, the n and name of the best one."""
    order = np.array(sorted(range(len(stored)), key=stored.__getitem__), np.int64)
    stored, stored_n = [stored[i] for i in order.tolist()], stored_n[order]
    vecs = vectors(stored)
    by_vec = np.lexsort(vecs.T[::-1])
    stored, stored_n, vecs = [stored[i] for i in by_vec.tolist()], stored_n[by_vec], vecs[by_vec]
    words = stored + probes
    counts = np.concatenate([stored_n, probe_n])
    letters, probe_vecs = _Letters(words), vectors(probes)
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for probe, found in candidates(vecs, probe_vecs, depth):
        good = verified(words, probe + len(stored), found, letters)
        probe, found = probe[good], found[good]
        same = (probe_vecs[probe] == vecs[found]).all(1)  # these search each other
        left += [probe + len(stored), found[~same]]
        right += [found, probe[~same] + len(stored)]
    target, near = np.concatenate(left), np.concatenate(right)
    rank = np.empty(len(words), np.int64)
    rank[np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)] = np.arange(len(words))
    # A word may stand on both sides of a subtree; either place gets rows of its own, summed up later.
    sort = np.lexsort((rank[near], -counts[near], target))
    target, near = target[sort], near[sort]
    firsts = np.flatnonzero(np.diff(target, prepend=-1))
    sizes = np.diff(np.append(firsts, len(target)))
    return (
        [words[i] for i in target[firsts].tolist()], sizes, counts[near[firsts]], [words[i] for i in near[firsts].tolist()],
    )


def near_words(words: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``word``, ``n_near`` and the near word of largest ``n`` (``best``, ``best_n``) of every word that has near words.

    ``words``: distinct ``word`` with its ``n``; any letters. Words with the
    same vector beyond ``limit`` are held in several blocks that every
    searching word visits.
    """
    words = materialize(_with_vectors(words), "words")
    opened = open_nodes(words, limit)

    def work(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        depth = len(key[0].as_py())
        found = near_in_subtree(
            left.column("word").to_pylist(), left.column("n").to_numpy(),
            right.column("word").to_pylist(), right.column("n").to_numpy(), depth,
        )
        return pa.table(
            [pa.array(found[0], pa.string()), pa.array(found[1], pa.int64()), pa.array(found[2], pa.int64()), pa.array(found[3], pa.string())],
            ["word", "n_near", "best_n", "best"],
        )

    stored = _dealt(words, opened, limit, searching=False).drop("vec")
    probes = _dealt(words, opened, limit, searching=True).drop("vec")
    keys = ["node", "block"]
    found = stored.groupBy(*keys).cogroup(probes.groupBy(*keys)).applyInArrow(work, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("best")
    summed = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return summed.select("word", "n_near", F.col("best.word").alias("best"), (-F.col("best.n")).alias("best_n"))


def roots(forms: DataFrame) -> DataFrame:
    """``word``, ``root``: the end of the chain of forms, by pointer doubling.

    ``forms``: ``word``, ``form``; a form has a larger n by ``FORM_RATIO``,
    so chains are short and never closed. Each round is written out.
    """
    current = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = current.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = current.join(ahead, "root", "left")
        after = materialize(moved.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "roots")
        if after.where("_moved").isEmpty():
            return after.select("word", "root")
        current = after.drop("_moved")


def variant_groups(
    documents: DataFrame, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, ratio: int = FORM_RATIO,
    delete_mod: int = DELETE_MOD, limit: int = LIMIT,
) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n``, ``root`` of every word of the texts that is frequent enough.

    No words give no rows. Extra columns are not read.
    """
    counted = run_counts(documents, delete_mod, min_letters).where(F.col("n") >= min_count)
    words = materialize(counted, "words")
    near = materialize(near_words(words, limit), "near")
    forms = near.join(words, "word").where(F.col("best_n") >= ratio * F.col("n")).select("word", F.col("best").alias("form"))
    ends = roots(forms)
    return (
        words.join(near, "word", "left")
        .join(ends, "word", "left")
        .select(
            "word",
            F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best")).alias("form"),
            F.coalesce("root", "word").alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best_n")).alias("form_n"),
        )
    )
