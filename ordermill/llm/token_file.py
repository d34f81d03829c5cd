"""Token ids as files: one concatenated id array per segment, its document boundaries Elias-Fano coded.

Layout of a segment, all little-endian::

    8 bytes   magic "TOKSEG01"
    u32       bytes per id (2 or 4)
    u32       l, the number of low bits
    u64       n, documents            u64   u, ids
    u64       bytes of the low part   u64   bytes of the high part
    u32[]     select samples: bit place of every 256th one in the high part
    low       n numbers of l bits each, packed
    high      unary coded high parts: bit (end[i] >> l) + i is set
    ids       u ids

``end[i]`` is the number of ids up to the end of document i, so the whole
boundary table takes about 2 + log2(u / n) bits a document, and ``select``
finds one end by a look at one sample and at most a few words.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermill.llm.batches import slices
from ordermill.llm.tokens import with_end, word_tokens

MAGIC = b"TOKSEG01"
HEADER = struct.Struct("<8sIIQQQQ")
SAMPLE = 256
SEGMENT_TOKENS = 1 << 20  # a segment is closed once it holds so many ids
END_ID = 1

SEGMENT_SCHEMA = (
    "bucket int, segment int, first_doc long, last_doc long, documents long, tokens long, "
    "doc_ids binary, payload binary"
)


class EliasFano:
    """A rising sequence in about 2 + log2(u / n) bits a member."""

    def __init__(self, size: int, total: int, low_bits: int, low: bytes, high: bytes, samples: np.ndarray) -> None:
        self.size, self.total, self.low_bits = size, total, low_bits
        self.low, self.high, self.samples = low, high, samples
        self._low = np.unpackbits(np.frombuffer(low, np.uint8), bitorder="little")

    @classmethod
    def build(cls, ends: np.ndarray) -> EliasFano:
        size, total = len(ends), int(ends[-1]) if len(ends) else 0
        low_bits = max(0, (total // size).bit_length() - 1) if size else 0
        shifts = np.arange(low_bits)
        low = np.packbits((ends[:, None] >> shifts & 1).astype(np.uint8).ravel(), bitorder="little")
        places = (ends >> low_bits) + np.arange(size)
        bits = np.zeros(int(places[-1]) + 1 if size else 0, np.uint8)
        bits[places] = 1
        high = np.packbits(bits, bitorder="little")
        return cls(size, total, low_bits, low.tobytes(), high.tobytes(), places[::SAMPLE].astype("<u4"))

    def _low_part(self, index: np.ndarray) -> np.ndarray:
        shifts = np.arange(self.low_bits)
        bits = self._low[np.asarray(index)[..., None] * self.low_bits + shifts]
        return (bits.astype(np.int64) << shifts).sum(-1)

    def select(self, index: int) -> int:
        """Member ``index``: start at its sample, count set bits byte by byte."""
        if not 0 <= index < self.size:
            raise IndexError(index)
        place = int(self.samples[index // SAMPLE])
        left = index % SAMPLE
        byte, bit = divmod(place, 8)
        word = self.high[byte] >> bit << bit
        while (ones := word.bit_count()) <= left:
            left -= ones
            byte += 1
            word = self.high[byte]
        for _ in range(left):
            word &= word - 1
        place = byte * 8 + (word & -word).bit_length() - 1
        return ((place - index) << self.low_bits) + int(self._low_part(np.array(index)))

    def all(self) -> np.ndarray:
        places = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))
        return (places - np.arange(self.size) << self.low_bits) + self._low_part(np.arange(self.size))


def write_segment(ids: np.ndarray, ends: np.ndarray, width: int) -> bytes:
    code = EliasFano.build(ends)
    head = HEADER.pack(MAGIC, width, code.low_bits, code.size, code.total, len(code.low), len(code.high))
    body = ids.astype("<u2" if width == 2 else "<u4").tobytes()
    return b"".join([head, code.samples.tobytes(), code.low, code.high, body])


class Segment:
    """Random access to the documents of a segment's bytes."""

    def __init__(self, payload: bytes) -> None:
        magic, width, low_bits, size, total, low_bytes, high_bytes = HEADER.unpack_from(payload)
        if magic != MAGIC:
            raise ValueError("not a token segment")
        at = HEADER.size
        samples = np.frombuffer(payload, "<u4", -(-size // SAMPLE), at)
        at += samples.nbytes
        low, high = payload[at : at + low_bytes], payload[at + low_bytes : at + low_bytes + high_bytes]
        self.ends = EliasFano(size, total, low_bits, low, high, samples)
        self.ids = np.frombuffer(payload, "<u2" if width == 2 else "<u4", total, at + low_bytes + high_bytes)

    def __len__(self) -> int:
        return self.ends.size

    def bounds(self, index: int) -> tuple[int, int]:
        return (self.ends.select(index - 1) if index else 0), self.ends.select(index)

    def document(self, index: int) -> np.ndarray:
        start, stop = self.bounds(index)
        return self.ids[start:stop]


def write(documents: DataFrame, tokenizer: str, path: str, end_id: int = END_ID, partitions: int | None = None) -> None:
    """Tokenise ``doc_id``, ``text`` and write segments in ascending ``doc_id`` order below ``path``.

    Documents are dealt to ranges of ids, each range sorted by one task that
    closes a segment about every ``SEGMENT_TOKENS`` ids, so a task holds one
    segment and one slice of text. A segment is a row of a Parquet table:
    Spark commits the files of a task as a whole and every file system that
    Spark writes to will do. Null text: the end id alone. Null ids come
    first. Rows with the same id stand side by side, in order of their text.
    Extra columns are not read. An empty table gives files without segments.
    """
    spark = documents.sparkSession
    count = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = word_tokens(tokenizer)
        width = 2 if max(encoder.library.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        bucket = TaskContext.get().partitionId()
        number, docs, parts, ends, total = 0, [], [], [], 0

        def close() -> pa.RecordBatch:
            known = [doc for doc in docs if doc is not None]
            row = {
                "bucket": [bucket], "segment": [number],
                "first_doc": [known[0] if known else None], "last_doc": [known[-1] if known else None],
                "documents": [len(docs)], "tokens": [total],
                "doc_ids": [pa.array(docs, pa.int64()).fill_null(NO_ID).to_numpy().astype("<i8").tobytes()],
                "payload": [write_segment(np.concatenate(parts), np.concatenate(ends), width)],
            }
            return pa.RecordBatch.from_pydict(row, schema=SEGMENT_ARROW)

        for batch in batches:
            for part in slices(batch):
                ids, offsets = with_end(*encoder(part.column("text")), end_id)
                docs += part.column("doc_id").to_pylist()
                parts.append(ids)
                ends.append(offsets[1:] + total)
                total += len(ids)
                if total >= SEGMENT_TOKENS:
                    yield close()
                    number, docs, parts, ends, total = number + 1, [], [], [], 0
        if docs:
            yield close()

    narrow = documents.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    (
        narrow.repartitionByRange(count, F.col("doc_id").asc_nulls_first())
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
        .mapInArrow(work, SEGMENT_SCHEMA)
        .write.option("compression", "zstd")
        .parquet(path)
    )


NO_ID = -(1 << 63)  # stands for a null id in a segment's id list
SEGMENT_ARROW = pa.schema(
    [
        ("bucket", pa.int32()), ("segment", pa.int32()), ("first_doc", pa.int64()), ("last_doc", pa.int64()),
        ("documents", pa.int64()), ("tokens", pa.int64()), ("doc_ids", pa.binary()), ("payload", pa.binary()),
    ]
)
READ_SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long, bucket int, segment int, position long, ids array<int>"


def _segment_starts(segments: DataFrame) -> DataFrame:
    """``start``: ids of all segments before each one.

    A running sum inside each bucket, and one over the buckets' totals: one
    row per write task, the only rows that meet in a single task.
    """
    inside = Window.partitionBy("bucket").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    sizes = segments.select("bucket", "segment", "tokens")
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (
        sizes.groupBy("bucket")
        .agg(F.sum("tokens").alias("_all"))
        .select("bucket", F.coalesce(F.sum("_all").over(before), F.lit(0)).alias("_before"))
    )
    return sizes.join(F.broadcast(buckets), "bucket").select(
        "bucket", "segment",
        (F.coalesce(F.sum("tokens").over(inside), F.lit(0)) + F.col("_before")).alias("start"),
    )


def read(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """One row per document of the files below ``path``, in terms of their own bytes.

    ``start``: ids of all documents before it. ``position``: its place in the
    segment. Offsets come from the Elias-Fano code; ids from the id array.
    """
    segments = spark.read.parquet(path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                segment = Segment(row["payload"])
                docs = np.frombuffer(row["doc_ids"], "<i8")
                ends = segment.ends.all()
                starts = np.concatenate([[0], ends[:-1]])
                own = [segment.ids[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array(docs, pa.int64(), mask=docs == NO_ID),
                        "start": pa.array(starts, pa.int64()),
                        "n_tokens": pa.array(ends - starts, pa.int64()),
                        "ids_crc32": pa.array([zlib.crc32(one.astype("<u4").tobytes()) for one in own], pa.int64()),
                        "bucket": pa.array([row["bucket"]] * len(own), pa.int32()),
                        "segment": pa.array([row["segment"]] * len(own), pa.int32()),
                        "position": pa.array(range(len(own)), pa.int64()),
                        "ids": pa.array([one.astype(np.int32) if with_ids else None for one in own], pa.list_(pa.int32())),
                    }
                )

    documents = segments.select("bucket", "segment", "doc_ids", "payload").mapInArrow(work, READ_SCHEMA)
    starts = _segment_starts(segments).withColumnRenamed("start", "_segment_start")
    return documents.join(starts, ["bucket", "segment"]).select(
        "doc_id", (F.col("start") + F.col("_segment_start")).alias("start"), "n_tokens", "ids_crc32",
        "bucket", "segment", "position", "ids",
    )
