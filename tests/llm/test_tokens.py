from __future__ import annotations

import functools
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from ordermill.llm import packing, token_file
from ordermill.llm.piece_table import encode_decode, piece_table
from ordermill.llm.tokens import word_tokens

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def reference_ids(text: str | None) -> list[int]:
    return words_library().encode(text or "", add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=6))
def test_words_equal_the_library(texts):
    encoder = word_tokens(WORDS)
    ids, ends = encoder(pa.array(texts, pa.string()))
    expected = encoder.library.encode_batch(texts, add_special_tokens=False)
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [one.ids for one in expected]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("abstdlvmreABZ019'’<|>/.,-_!~^`\"&= \t\n\x00\x1c\x7f\x85\xa0éÉ\u0301\u030cJjſK\u212a漢１²"), max_size=40), max_size=5))
def test_parts_of_plain_words_equal_the_library(texts):
    texts = [*texts, "<|endoftext|> x<|startoftext|>y <|ENDOFTEXT|>", "don't it''s 'sabc a'LLb ''d", "A1b22c...3,4--x", "J\u030c e\u0301X"]
    encoder = word_tokens(WORDS)
    ids, ends = encoder(pa.array(texts, pa.string()))
    expected = words_library().encode_batch(texts, add_special_tokens=False)
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:])] == [one.ids for one in expected]


@functools.cache
def pieces_library() -> SentencePieceProcessor:
    return SentencePieceProcessor(model_file=PIECES)


@functools.cache
def words_library() -> Tokenizer:
    return Tokenizer.from_file(WORDS)


ODD = ["", " ", "  ", "   a", "a  ", " " * 15, " " * 16, " " * 33, "a" + " " * 15 + "\t" + " " * 31 + "b", "▁x ▁▁ y", "</s><s><0x0A>", "\x00", "執日本 😀é"]


@settings(max_examples=60, deadline=None)
@given(st.text(st.sampled_from("abcdefghinorstu    ▁.,\n\téß執😀\x00A1"), max_size=60))
def test_pieces_equal_the_library(text):
    table, library = piece_table(PIECES), pieces_library()
    for one in (text, ODD[len(text) % len(ODD)]):
        ids, _ = table.encode(pa.array([one]))
        expected = library.encode(one, add_eos=True)
        assert ids.tolist() == expected
        assert table.decode(expected) == library.decode(expected)


def test_whole_documents_in_pieces(spark, documents, nothing):
    library = SentencePieceProcessor(model_file=PIECES)
    texts = {}
    for row in documents.select("doc_id", "text").collect():
        texts.setdefault(row["doc_id"], []).append(row["text"] or "")
    found = encode_decode(documents, PIECES).collect()
    assert len(found) == documents.count()
    for row in found:
        fits = [library.encode(text, add_eos=True) for text in texts[row["doc_id"]]]
        assert row["ids"] in fits and row["n_tokens"] == len(row["ids"])
        assert row["decoded"] == library.decode(row["ids"])
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, row["ids"])).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(row["decoded"].encode()).hexdigest()
    assert encode_decode(nothing, PIECES).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 300), max_size=700), st.integers(0, 1000))
def test_elias_fano_round_trip(sizes, at):
    ends = np.cumsum(np.array(sizes, np.int64))
    code = token_file.EliasFano.build(ends)
    assert code.all().tolist() == ends.tolist()
    if len(sizes):
        assert code.select(at % len(sizes)) == ends[at % len(sizes)]
        bits = 8 * (len(code.low) + len(code.high) - 2)
        assert bits <= len(sizes) * (3 + max(0, np.log2(max(ends[-1] / len(sizes), 1))))
    with pytest.raises(IndexError):
        code.select(len(sizes))


def test_files_hold_every_document(spark, documents, nothing, folder):
    token_file.write(documents, WORDS, f"{folder}/tokens", partitions=3)
    rows = sorted(
        ((r["doc_id"], r["text"] or "") for r in documents.select("doc_id", "text").collect()),
        key=lambda row: (row[0] is not None, row[0] or 0, row[1].encode()),
    )
    found = token_file.read(spark, f"{folder}/tokens").orderBy("start").collect()
    start = 0
    assert len(found) == len(rows)
    for row, (doc, text) in zip(found, rows):
        ids = [*reference_ids(text), token_file.END_ID]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        assert (row["doc_id"], row["start"], row["n_tokens"], row["ids_crc32"]) == (doc, start, len(ids), crc)
        assert row["ids"] == ids
        start += len(ids)
    segment = spark.read.parquet(f"{folder}/tokens").orderBy("bucket", "segment").first()
    opened = token_file.Segment(segment["payload"])
    assert opened.document(0).tolist() == [*reference_ids(rows[0][1]), token_file.END_ID]
    token_file.write(nothing, WORDS, f"{folder}/none", partitions=2)
    assert token_file.read(spark, f"{folder}/none").count() == 0


def test_packing_keeps_every_id_once_in_order(spark, documents, nothing):
    texts: dict = {}
    for row in documents.select("doc_id", "text").collect():
        texts.setdefault(row["doc_id"], []).append([*reference_ids(row["text"]), packing.END_ID])
    found = packing.pack(documents, WORDS, length=64).collect()
    sequences: dict = {}
    pieces: dict = {}
    for row in found:
        sequences.setdefault(row["sequence_id"], []).append(row)
        pieces.setdefault((row["doc_id"], row["doc_tokens"]), []).append(row)
        assert row["ids_crc32"] == zlib.crc32(np.array(row["ids"], "<u4").tobytes())
    for rows in sequences.values():
        rows.sort(key=lambda row: row["offset"])
        at = 0
        for row in rows:
            assert row["offset"] == at
            at += row["length"]
        assert at == rows[0]["sequence_length"] <= 64
        assert rows[0]["padding"] == (0 if at & (at - 1) == 0 else 64 - at)
    for doc, versions in texts.items():
        for ids in versions:
            own = sorted(pieces[doc, len(ids)], key=lambda row: (row["start"], row["ids_crc32"]))
            assert {number for row in own for number in range(row["start"], row["start"] + row["length"])} == set(range(len(ids)))
    assert sum(row["length"] for row in found) == sum(len(ids) for versions in texts.values() for ids in versions)
    assert packing.pack(nothing, WORDS).count() == 0


def brute_cost(ends: list[int], penalties: list[float], length: int) -> float:
    best = {0: 0.0}
    for end, penalty in zip(ends, penalties):
        free = (length // 2, length // 4)
        options = [
            best[start] + packing.WINDOW_COST + penalty + (0 if end - start in free else length - (end - start))
            for start in best
            if end - start <= length
        ]
        best[end] = min(options)
    return best[ends[-1]]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 16), st.sampled_from([0.0, 8.0, 64.0])), min_size=1, max_size=60))
def test_cuts_are_the_cheapest(parts):
    ends = np.cumsum([size for size, _ in parts])
    penalties = np.array([penalty for _, penalty in parts])
    chosen = packing.best_cuts(ends, penalties, 16)
    start, cost = 0, 0.0
    for index in chosen:
        size = int(ends[index]) - start
        assert size <= 16
        cost += packing.WINDOW_COST + penalties[index] + (0 if size in (8, 4) else 16 - size)
        start = int(ends[index])
    assert start == ends[-1]
    assert cost == pytest.approx(brute_cost(ends.tolist(), penalties.tolist(), 16))


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 150), st.sampled_from([0.0, 8.0])), min_size=1, max_size=10), st.sampled_from([16, 128, 256]))
def test_cuts_at_any_id_are_the_cheapest(parts, length):
    ends = np.cumsum([size for size, _ in parts])
    penalties = np.full(ends[-1], packing.HARD_PENALTY)
    penalties[ends - 1] = [penalty for _, penalty in parts]
    start, cost, free = 0, 0.0, (length // 2, length // 4)
    for cut in packing.cheapest_cuts(penalties, length).tolist():
        assert 0 < cut - start <= length
        cost += packing.WINDOW_COST + penalties[cut - 1] + (0 if cut - start in free else length - (cut - start))
        start = cut
    assert start == ends[-1]
    assert cost == pytest.approx(brute_cost(list(range(1, start + 1)), penalties.tolist(), length))


@pytest.mark.parametrize("sizes", [[2100] * 60, [3000, 5000] * 20])
def test_documents_without_marks_need_little_padding(sizes):
    block = packing.Block(np.zeros(10, bool), packing.LENGTH)
    block.add(list(range(len(sizes))), np.zeros(sum(sizes), np.uint32), np.concatenate([[0], np.cumsum(sizes)]))
    rows = list(block.pack(0, final=True))
    assert sum(len(row[-1]) for row in rows) == sum(sizes)
    padded = {row[3]: row[6] for row in rows}
    assert sum(padded.values()) < 0.02 * sum(sizes)


def test_sentence_marks_of_other_scripts():
    library = words_library()
    marks, tails = packing.sentence_ids(library), packing.byte_tails(library)
    for mark in packing.SENTENCE_MARKS + packing.WIDE_MARKS:
        ids = np.array(reference_ids(f"执日本{mark} 日本 本 a"), np.uint32)
        at = np.flatnonzero(packing.mark_places(ids, marks, tails))
        assert at.tolist() == [len(reference_ids(f"执日本{mark}")) - 1], mark


def test_blocks_carry_their_open_window():
    chooser = random.Random(2)
    marks = np.zeros(100, bool)
    marks[7] = True
    block = packing.Block(marks, 16)
    rows, total = [], 0
    for step in range(20):
        sizes = [chooser.randint(1, 40) for _ in range(5)]
        ids = np.array([chooser.randint(0, 99) for _ in range(sum(sizes))], np.uint32)
        block.add([f"{step}-{i}" for i in range(5)], ids, np.concatenate([[0], np.cumsum(sizes)]))
        total += len(ids)
        rows += list(block.pack(0, final=step == 19))
    assert sum(len(row[-1]) for row in rows) == total
    short = [row for row in rows if row[5] < 12 and row[3] < rows[-1][3] - 4]
    assert len({row[3] for row in short}) < 0.5 * len({row[3] for row in rows})


def test_long_runs_of_blanks_are_linear():
    table, library = piece_table(PIECES), pieces_library()
    for count in [*range(1, 140), 1000, 4097]:
        for text in (" " * count, "a" + " " * count + "b"):
            ids, _ = table.encode(pa.array([text]))
            assert ids.tolist() == [*library.encode(text), 2]
    ids, _ = table.encode(pa.array(["x" + " " * 1_000_000 + "y"]))
    assert table.decode(ids[:-1].tolist()) == "x" + " " * 1_000_000 + "y"
