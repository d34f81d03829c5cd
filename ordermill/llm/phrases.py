"""Phrase collocations: counts of all word runs from truncated suffix trees that are built apart from each other.

Every word occurrence starts a suffix of at most five words inside its piece.
The suffixes are dealt out by vertical partitioning: prefixes of two words are
packed into groups of about one ``budget`` of suffixes, and a prefix that may
hold more than a quarter of it alone is extended by its next word. Each group
builds the part of the suffix tree below its prefixes level by level, without
the rest of the texts: the leaves' totals give the counts of all nodes above
them, and below a node that is too rare nothing is built.

The range of words read grows with what is still open. Single words are
counted first; then trees of two words over the frequent words; only suffixes
whose pairs of words are all frequent are read up to five words. What is
frequent is told to the tasks by bitmaps of fixed size, in which a rare pair may
share the bit of a frequent one and is then counted for nothing.

A prefix is extended if all its pairs of words are ``heavy``, that is occur more
than ``budget / 4`` times; there are at most ``4 * words / budget`` such pairs.
Counts of extended prefixes come from several groups and are summed up.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.batches import slices
from ordermill.llm.spans import Words, byte_set, split_words
from ordermill.operators.skew import hot_keys, join_one
from ordermill.sources.scratch import materialize

BREAKS = byte_set(b".,;:!?\n\v\f\r")
BLANKS = byte_set(b" \t")
MAX_WORDS = 5
MIN_COUNT = 100
TOP = 2000
SLICE = 8 << 20
LEAST_BUDGET, MOST_BUDGET = 1 << 12, 1 << 22
PARTS = 64  # a budget is about this share of all words
WORD_BITS, PAIR_BITS = 24, 26  # sizes of the bitmaps of frequent words and pairs, whatever their number


def _key(lang: Column, word: Column) -> Column:
    return F.crc32(F.concat(lang.cast("binary"), F.lit(b"\0"), word.cast("binary")))


def _keys(lang: str, words: pa.Array) -> np.ndarray:
    seed = zlib.crc32(lang.encode() + b"\0")
    return np.fromiter((zlib.crc32(word, seed) for word in pc.cast(words, pa.binary()).to_pylist()), np.int64, len(words))


def _texts(documents: DataFrame) -> DataFrame:
    return documents.selectExpr("coalesce(cast(lang as string), 'und') lang", "cast(text as string) text").where("text <> ''")


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, Words]]:
    for part in slices(batch, limit=SLICE):
        for lang in pc.unique(part.column("lang")).to_pylist():
            rows = part.filter(pc.equal(part.column("lang"), lang))
            found = split_words(rows.column("text"), BLANKS, BREAKS)
            if len(found.codes):
                yield lang, found


def word_counts(documents: DataFrame) -> DataFrame:
    """``lang``, ``word``, ``n``: all occurrences; a null language is ``und``, a null text has no words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, found in _by_language(batch):
                counts = np.bincount(found.codes, minlength=len(found.names))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(counts), pa.string()), found.names, pa.array(counts, pa.int64())], ["lang", "word", "n"]
                )

    counted = _texts(documents).mapInArrow(work, "lang string, word string, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


# Vertical partitioning -------------------------------------------------------------


def bitmap_of(slots: DataFrame, bits: int) -> np.ndarray:
    """The column ``slot`` as a bitmap of ``2 ** bits`` bits, merged from partial bitmaps of 4 KB."""
    counted = slots.select((F.col("slot") + 1).alias("slot"))  # the functions count from 1
    buckets = counted.groupBy(F.bitmap_bucket_number("slot").alias("bucket"))
    table = np.zeros(1 << bits >> 3, np.uint8)
    for row in buckets.agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")).collect():
        part = np.frombuffer(bytes(row["bits"]), np.uint8)
        table[(row["bucket"] - 1) * len(part) :][: len(part)] = part
    return table


def _marked(table: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (table[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1


def _mix(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of a run from the hash of its first words and the key of the next one."""
    left = left * np.uint64(0x9E3779B97F4A7C15)
    return ((left ^ (left >> np.uint64(32))) + right.astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)


def _pair_slots(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (_mix(left.astype(np.uint64), right) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)


class Partition:
    """Which suffixes are read, how far, and to which group they go."""

    def __init__(self, groups: int, words: np.ndarray, pairs: np.ndarray | None = None, heavy: dict[str, list[str]] | None = None) -> None:
        self.groups, self.words, self.pairs, self.heavy = groups, words, pairs, heavy or {}

    def heavy_codes(self, lang: str, names: pa.Array) -> np.ndarray:
        """Heavy pairs as sorted numbers: place of the first word times the number of names, plus that of the second."""
        pairs = [phrase.split(" ") for phrase in self.heavy.get(lang, ())]
        flat = pa.array([word for pair in pairs for word in pair], pa.string())
        places = pc.fill_null(pc.index_in(flat, names), -1).to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, 2)
        places = places[(places >= 0).all(1)]
        return np.sort(places[:, 0] * len(names) + places[:, 1])

    def suffixes(self, lang: str, found: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct suffixes of a slice: word places counted from 1 (0: none), one column a word; how often; their group.

        A suffix ends before the first rare word and before the first rare
        pair: no phrase across one is frequent. Suffixes of one word are left out.
        """
        keys = _keys(lang, found.names)
        size = len(found.names) + 1
        good = _marked(self.words, keys & ((1 << WORD_BITS) - 1))
        codes = np.append(found.codes, 0)  # a place after the last word
        joined = np.append(found.pieces[1:] == found.pieces[:-1], [False]) & good[found.codes] & good[codes[1:]]
        if self.pairs is not None:
            at = np.flatnonzero(joined)
            joined[at] = _marked(self.pairs, _pair_slots(keys[codes[at]], keys[codes[at + 1]]))
        first = np.flatnonzero(joined)
        width = 2 if self.pairs is None else MAX_WORDS
        number, times, columns = codes[first] + 1, None, [codes[first] + 1]
        alive = np.ones(len(first), bool)
        at = first
        for _ in range(1, width):
            alive = alive & joined[np.minimum(at, len(joined) - 1)]
            at = at + 1
            columns.append(np.where(alive, codes[np.minimum(at, len(codes) - 1)] + 1, 0))
            _, number = np.unique(number * size + columns[-1], return_inverse=True)  # numbers of equal suffixes
        _, sample, times = np.unique(number, return_index=True, return_counts=True)
        ids = np.stack([column[sample] for column in columns])
        return ids, times, self._groups(lang, ids, keys, found.names)

    def _groups(self, lang: str, ids: np.ndarray, keys: np.ndarray, names: pa.Array) -> np.ndarray:
        heavy = self.heavy_codes(lang, names)
        padded = np.append(0, keys)
        mixed = _mix(padded[ids[0]].astype(np.uint64), padded[ids[1]])
        extended = np.ones(ids.shape[1], bool)
        for depth in range(2, len(ids)):
            extended &= np.isin((ids[depth - 2] - 1) * len(names) + ids[depth - 1] - 1, heavy) & (ids[depth - 1] > 0)
            mixed = np.where(extended, _mix(mixed, padded[ids[depth]]), mixed)
        return ((mixed >> np.uint64(32)) % np.uint64(self.groups)).astype(np.int64)


def dealt_suffixes(documents: DataFrame, partition: Partition) -> DataFrame:
    """``lang``, ``grp``, ``words``, ``ids``, ``suffixes``: the suffixes of a slice of texts that belong to one group, packed.

    ``words`` is the table of the words used, ``ids`` one column of unsigned
    places in it for each word of the suffixes, and one of their numbers of
    occurrences; 16 bits a place where they suffice.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, found in _by_language(batch):
                ids, times, groups = partition.suffixes(lang, found)
                order = np.argsort(groups, kind="stable")
                groups = groups[order]
                firsts = np.flatnonzero(np.diff(groups, prepend=-1))
                ends = np.append(firsts[1:], len(groups))[: len(firsts)]
                tables, packed = [], []
                for begin, end in zip(firsts.tolist(), ends.tolist()):
                    block = ids[:, order[begin:end]]
                    used = np.zeros(len(found.names) + 1, bool)
                    used[block.ravel()] = True
                    used[0] = False
                    local = np.cumsum(used) * used
                    tables.append(found.names.take(pa.array(np.flatnonzero(used) - 1)))
                    whole = np.vstack([local[block], times[None, order[begin:end]]])
                    packed.append(whole.astype(np.uint16 if whole.max() < 1 << 16 else np.uint32).tobytes())
                if not packed:
                    continue
                sizes = np.cumsum([0, *map(len, tables)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(packed), pa.string()), pa.array(groups[firsts], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(sizes), pa.concat_arrays(tables)), pa.array(packed, pa.binary()),
                        pa.array(ends - firsts, pa.int64()),
                    ],
                    ["lang", "grp", "words", "ids", "suffixes"],
                )

    return _texts(documents).mapInArrow(work, "lang string, grp long, words array<string>, ids binary, suffixes long")


# Subtrees ----------------------------------------------------------------------------


class Suffixes:
    """The suffixes of one group with a table of all its words."""

    def __init__(self, rows: pa.Table, width: int) -> None:
        lists = rows.column("words").combine_chunks()
        tables = [lists[number].values for number in range(len(lists))]
        coded = pa.concat_arrays(tables).dictionary_encode()
        self.names = coded.dictionary
        codes = np.append(coded.indices.to_numpy(zero_copy_only=False).astype(np.int32) + 1, 0)
        starts = np.cumsum([0, *map(len, tables)])
        blocks, times = [], []
        for start, packed, count in zip(starts, rows.column("ids").to_pylist(), rows.column("suffixes").to_pylist()):
            kind = np.uint16 if len(packed) == 2 * (width + 1) * count else np.uint32
            block = np.frombuffer(packed, kind).reshape(width + 1, count).astype(np.int64)
            blocks.append(codes[np.where(block[:-1] > 0, start + block[:-1] - 1, -1)])
            times.append(block[-1])
        self.columns, self.times = np.concatenate(blocks, axis=1), np.concatenate(times)


def subtree_counts(suffixes: Suffixes, least: int, heavy: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Nodes from two words on with at least ``least`` occurrences here: phrases, occurrences, last two words' places.

    Level by level: a node's number and the next word make the number of its
    child, and the times of all suffixes with a child's number are the total
    of the leaves below it. Nodes of heavy pairs alone are kept however rare,
    for other groups hold the rest of them.
    """
    names, size = suffixes.names.to_pylist(), len(suffixes.names) + 1
    node, texts = suffixes.columns[0].astype(np.int64), ["", *names]
    phrases, totals, pairs = [], [np.zeros(0, np.int64)], [np.zeros((0, 2), np.int64)]
    rows, extended = np.arange(len(node)), np.ones(size, bool)
    last = np.arange(size) - 1  # place of a node's last word
    for column in suffixes.columns[1:]:
        word = column[rows].astype(np.int64)
        rows, node, word = rows[word > 0], node[word > 0], word[word > 0]
        values, inverse = np.unique(node * size + word, return_inverse=True)
        counts = np.bincount(inverse, suffixes.times[rows], minlength=len(values)).astype(np.int64)
        heads, tails = values // size, values % size - 1
        spread = extended[heads] & np.isin(last[heads] * len(names) + tails, heavy)
        keep = (counts >= least) | spread
        heads, tails = heads[keep], tails[keep]
        pairs.append(np.stack([last[heads], tails], axis=1))
        texts = [f"{texts[head]} {names[tail]}" for head, tail in zip(heads.tolist(), tails.tolist())]
        phrases += texts
        totals.append(counts[keep])
        alive = keep[inverse]
        rows, node = rows[alive], (np.cumsum(keep) - 1)[inverse[alive]]
        extended, last = spread[keep], tails
    return phrases, np.concatenate(totals), np.concatenate(pairs)


def _trees(documents: DataFrame, partition: Partition, least: int, width: int) -> DataFrame:
    """``lang``, ``phrase``, ``n``, ``slot`` (bit of the last pair of words) of the nodes of all groups."""

    def work(key: tuple, rows: pa.Table) -> pa.Table:
        lang = key[0].as_py()
        suffixes = Suffixes(rows, width)
        phrases, counts, pairs = subtree_counts(suffixes, least, partition.heavy_codes(lang, suffixes.names))
        keys = _keys(lang, suffixes.names)
        slots = _pair_slots(keys[pairs[:, 0]], keys[pairs[:, 1]])
        return pa.table(
            [pa.array([lang] * len(phrases), pa.string()), pa.array(phrases, pa.string()), pa.array(counts, pa.int64()), pa.array(slots, pa.int64())],
            ["lang", "phrase", "n", "slot"],
        )

    return dealt_suffixes(documents, partition).groupBy("lang", "grp").applyInArrow(work, "lang string, phrase string, n long, slot long")


def heavy_pairs(pairs: DataFrame, above: int) -> dict[str, list[str]]:
    heavy: dict[str, list[str]] = {}
    for row in pairs.where(F.col("n") > above).select("lang", "phrase").collect():
        heavy.setdefault(row["lang"], []).append(row["phrase"])
    return heavy


def frequent_phrases(documents: DataFrame, words: DataFrame, least: int = MIN_COUNT, budget: int | None = None) -> DataFrame:
    """``lang``, ``phrase``, ``n`` of every run of one to five words that occurs at least ``least`` times.

    ``words``: the stored ``word_counts`` of the same documents. ``budget``:
    suffixes of one group; by default a share of all words within fixed bounds.
    """
    total = words.agg(F.sum("n")).first()[0] or 0
    budget = budget or min(max(total // PARTS, LEAST_BUDGET), MOST_BUDGET)
    groups = max(1, -(-total // budget))
    often = words.where(F.col("n") >= least)
    known = bitmap_of(often.select(_key(F.col("lang"), F.col("word")).bitwiseAND(F.lit((1 << WORD_BITS) - 1)).alias("slot")), WORD_BITS)
    pairs = materialize(_trees(documents, Partition(groups, known), least, 2), "pairs")
    partition = Partition(groups, known, bitmap_of(pairs, PAIR_BITS), heavy_pairs(pairs, budget // 4))
    trees = _trees(documents, partition, least, MAX_WORDS).where(F.size(F.split("phrase", " ")) > 2)
    longer = trees.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    single = often.select("lang", F.col("word").alias("phrase"), "n")
    return single.unionAll(pairs.select("lang", "phrase", "n")).unionAll(longer)


# Collocations --------------------------------------------------------------------------


def _part(first: Column, count: Column) -> Column:
    return F.array_join(F.slice(F.col("words"), first, count), " ")


def collocations(documents: DataFrame, least: int = MIN_COUNT, top: int = TOP, budget: int | None = None) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``: the best phrases of every language.

    A phrase of two to five words that occurs ``a >= least`` times scores by
    its weakest cut, floor(1000 * a * n / (l * r)), in decimals of 38
    digits. Phrases that lie inside a longer one
    which occurs as often are left out. Ties: more occurrences, then the
    phrase in byte order. A null language is ``und``; null and empty texts
    have no words; repeated rows count each. Extra columns are not read.
    """
    words = materialize(word_counts(documents), "words")
    counts = materialize(frequent_phrases(documents, words, least, budget), "phrases")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    long = counts.withColumn("words", F.split("phrase", " ")).where(F.size("words") > 1).withColumnRenamed("n", "a")

    inner = long.where(F.size("words") > 2).selectExpr(
        "lang", "a",
        "explode(flatten(transform(sequence(2, size(words) - 1), k -> transform(sequence(1, size(words) - k + 1),"
        " i -> array_join(slice(words, i, k), ' '))))) phrase",
    )
    covered = inner.groupBy("lang", "phrase").agg(F.max("a").alias("covering"))
    candidates = materialize(
        long.join(covered, ["lang", "phrase"], "left").where("covering is null or covering < a").drop("covering"), "candidates"
    )

    cuts = candidates.select(
        "lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k")
    ).select(
        "lang", "phrase", "a", "k", _part(F.lit(1), F.col("k")).alias("first"), _part(F.col("k") + 1, F.size("words") - F.col("k")).alias("rest")
    )
    lefts = counts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    rights = counts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    paired = cuts.join(lefts, ["lang", "first"]).join(rights, ["lang", "rest"])
    scored = (
        join_one(paired, totals, "lang", "phrase", "inner", hot=hot_keys(candidates, "lang"))
        .withColumn("score", F.expr("div(1000 * cast(a as decimal(18,0)) * cast(n as decimal(16,0)), cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"))
    )
    weakest = scored.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r", "a", "n")).alias("cut")
    )
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return (
        weakest.select("lang", "phrase", "cut.a", "cut.l", "cut.r", "cut.n", F.col("cut.score").alias("score"))
        .withColumn("rank", F.row_number().over(order).cast("long"))
        .where(F.col("rank") <= top)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
