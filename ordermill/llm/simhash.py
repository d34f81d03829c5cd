"""SimHash fingerprints and near-duplicate groups by covering locality-sensitive hashing.

A family of 2**(r + 1) - 1 bit masks covers radius r: every bit place i gets
a vector of r + 1 bits, and mask v holds the places whose vector has an odd
product with v. Up to r differing places give at most r equations in r + 1
unknowns, so some non-zero v is even with all of them: its mask leaves all
differing places out and both fingerprints fall into one bucket of that
table. No pair within the radius is ever missed.

A table's mask keeps half of the places. Buckets that are still large are
split again by masks over the places left out, which covers their pairs in
the same way, so no bucket is cut off and none meets whole in one task.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.llm.batches import filled, list_parts, slices
from ordermill.llm.components import components, unsent
from ordermill.operators.skew import join_one
from ordermill.sources.scratch import materialize

BITS = 64
WORDS = 4
RADIUS = 4
SEED = 42
BUCKET = 512  # fingerprints compared with each other at once; larger buckets are split first

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingle_hashes(text: bytes, words: int = WORDS, seed: int = SEED) -> np.ndarray:
    """XXH64 of every run of ``words`` words; fewer words: of the whole sequence; none: none."""
    from xxhash import xxh64_intdigest

    parts = text.translate(_LOWER).split()  # bytes split at 0x20 and 0x09 to 0x0D alone
    if not parts:
        return np.zeros(0, np.uint64)
    if len(parts) <= words:
        return np.array([xxh64_intdigest(b" ".join(parts), seed)], np.uint64)
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    count = len(parts) - words + 1
    spans = zip(starts[:count].tolist(), ends[words - 1 :].tolist())
    return np.fromiter((xxh64_intdigest(joined[a:b], seed) for a, b in spans), np.uint64, count)


def majority_bits(hashes: np.ndarray, chunk: int = 1 << 16) -> int:
    """Bits set in over half of the hashes; 0 for none."""
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), chunk):
        part = hashes[at : at + chunk].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int32)
    return sum(1 << bit for bit in np.flatnonzero(2 * counts > len(hashes)).tolist())


def fingerprints(documents: DataFrame, words: int = WORDS, seed: int = SEED) -> DataFrame:
    """``doc_id``, ``text_hash`` and ``fp`` (64 bits as a signed long) of every whole text.

    A null text or one without words has fingerprint zero. Rows with equal
    or null ids are kept. Extra columns are not read.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = pc.cast(filled(part.column("text")), pa.binary()).to_pylist()
                prints = [majority_bits(shingle_hashes(text, words, seed)) for text in texts]
                found = np.array(prints, np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_hash"), pa.array(found)],
                    ["doc_id", "text_hash", "fp"],
                )

    narrow = documents.selectExpr(
        "cast(doc_id as long) doc_id", "xxhash64(cast(text as string)) text_hash", "cast(text as string) text"
    )
    return narrow.mapInArrow(work, "doc_id long, text_hash long, fp long")


def covering_masks(radius: int, level: int = 0, seed: int = SEED) -> list[int]:
    """Masks over 64 places; any ``radius`` places are all left out by at least one mask.

    Vectors are dealt evenly, so each mask holds about half of the places,
    and so it does of the places that earlier levels left over.
    """
    size = (1 << (radius + 1)) - 1
    vectors = [1 + place % size for place in range(BITS)]
    random.Random(seed * 1000 + level).shuffle(vectors)
    return [
        sum(1 << place for place, vector in enumerate(vectors) if (vector & v).bit_count() % 2)
        for v in range(1, size + 1)
    ]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def forest(members: np.ndarray, radius: int) -> tuple[list[int], list[int]]:
    """Links that join all members within the radius of each other, directly or not; fewer than members."""
    near = np.bitwise_count(members[:, None] ^ members[None, :]) <= radius
    left, right = [], []
    unseen = np.ones(len(members), bool)
    for first in range(len(members)):
        if not unseen[first]:
            continue
        unseen[first] = False
        open_ones = [first]
        while open_ones:
            node = open_ones.pop()
            new = np.flatnonzero(near[node] & unseen)
            unseen[new] = False
            found = new.tolist()
            open_ones += found
            left += [node] * len(found)
            right += found
    return members[left].tolist(), members[right].tolist()


def _bucket_links(radius: int):
    """Links inside each bucket, by a spanning forest of its near pairs."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, offsets = list_parts(batch.column("fps"))
            prints = values.to_numpy().view(np.uint64)
            sizes = np.diff(offsets)
            first = offsets[:-1][sizes == 2]
            a, b = prints[first], prints[first + 1]
            near = np.bitwise_count(a ^ b) <= radius
            left, right = a[near].tolist(), b[near].tolist()
            for index in np.flatnonzero(sizes > 2).tolist():
                more = forest(prints[offsets[index] : offsets[index + 1]], radius)
                left += more[0]
                right += more[1]
            ends = [pa.array(np.array(side, np.uint64).view(np.int64)) for side in (left, right)]
            yield pa.RecordBatch.from_arrays(ends, ["a", "b"])

    return work


def links(prints: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) between distinct fingerprints of column ``fp``, enough to join all within the radius.

    Every pair of fingerprints within the radius shares a bucket of some
    table; from a bucket come at most as many links as it has members. A
    bucket of more than ``bucket`` members is dealt to smaller ones by the
    next level's masks, until all are small: members of a bucket differ only
    in the places not yet compared, and those halve with each level.

    Neither side of the join with the bucket sizes is broadcast: Spark would
    take the rows of all tables for as small as the fingerprints alone.
    """
    rows = prints.select("fp", F.lit(0).cast("long").alias("used"))
    found = None
    for level in range(BITS):
        masks = F.array(*[F.lit(_signed(mask)) for mask in covering_masks(radius, level)])
        tabled = (
            rows.select("fp", "used", F.explode(masks).alias("mask"))
            .select("fp", F.col("used").bitwiseOR(F.col("mask")).alias("used"))
            .withColumn("key", F.col("fp").bitwiseAND(F.col("used")))
        )
        if level:
            tabled = materialize(tabled.distinct(), "simhash-buckets")
        sizes = tabled.groupBy("used", "key").agg(F.count(F.lit(1)).alias("size"))
        small = tabled.join(sizes.where(F.col("size").between(2, bucket)).hint("merge"), ["used", "key"])
        part = materialize(
            small.groupBy("used", "key")
            .agg(F.collect_list("fp").alias("fps"))
            .select("fps")
            .mapInArrow(_bucket_links(radius), "a long, b long")
            .distinct(),
            "simhash-links",
        )
        found = part if found is None else found.unionAll(part)
        large = materialize(sizes.where(F.col("size") > bucket).select("used", "key"), "simhash-large")
        count = large.count()
        if not count:
            return found
        rows = materialize(tabled.join(unsent(large, count), ["used", "key"], "left_semi").select("fp", "used"), "simhash-split")
    raise AssertionError("all places are compared before the last level")


def groups(documents: DataFrame, radius: int = RADIUS, words: int = WORDS, seed: int = SEED) -> DataFrame:
    """``doc_id``, ``text_hash``, ``fp``, ``group``, ``component_id`` of every document.

    Documents link where their fingerprints differ in at most ``radius``
    places; ``group`` is the same for all that are joined (one of their
    fingerprints), ``component_id`` the smallest ``doc_id`` reachable, itself
    included. Equal fingerprints are one node, so copies never make pairs.
    Null ids are no candidates for the smallest; a group of null ids alone
    has component null. An empty table gives no rows.
    """
    prints = materialize(fingerprints(documents, words, seed), "simhash-prints")
    nodes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    joined = components(links(nodes.select("fp"), radius), "simhash-components")
    rooted = nodes.join(joined.withColumnRenamed("node", "fp").hint("merge"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp")
    )
    roots = rooted.groupBy("component").agg(F.min("least").alias("component_id"))
    of_print = rooted.join(roots, "component").select("fp", F.col("component").alias("group"), "component_id")
    return join_one(prints, of_print, "fp", "text_hash").select("doc_id", "text_hash", "fp", "group", "component_id")


def hex_print(column: str = "fp") -> Column:
    """A fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def drop_near_copies(documents: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One document of each group, with all its columns: the least (doc_id, hash of the text).

    Rows equal in both are one document and leave one row; rows that share an
    id but not a text are told apart.
    """
    found = groups(documents, radius)
    kept = (
        found.groupBy("group")
        .agg(F.min(F.struct("doc_id", "text_hash")).alias("_kept"))
        .select(*_row_key(F.col("_kept.doc_id"), F.col("_kept.text_hash")))
    )
    text_hash = F.xxhash64(F.col("text").cast("string"))
    keyed = documents.select("*", *_row_key(F.col("doc_id").cast("long"), text_hash))
    one = Window.partitionBy(*_ROW_KEY).orderBy("_kept_hash")  # as the join deals rows, so they move once
    return (
        keyed.join(kept, list(_ROW_KEY))
        .withColumn("_kept_row", F.row_number().over(one))
        .where("_kept_row = 1")
        .select(*[F.col(f"`{name}`") for name in documents.columns])
    )


_ROW_KEY = ("_kept_none", "_kept_id", "_kept_hash")


def _row_key(doc_id: Column, text_hash: Column) -> list[Column]:
    """A document's id and text hash without nulls."""
    values = (doc_id.isNull(), F.coalesce(doc_id, F.lit(0).cast("long")), text_hash)
    return [value.alias(name) for value, name in zip(values, _ROW_KEY)]
