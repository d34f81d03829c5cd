from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ordermill.llm import hidden_markov as hm


def random_model(classes: int = 11, states: int = 3, seed: int = 0) -> hm.Model:
    dice = np.random.default_rng(seed)
    start, move, emit = dice.random(states), dice.random((states, states)), dice.random((classes, states)) ** 6 + 1e-9
    return hm.Model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def sequences(seed: int, lengths: list[int], classes: int = 11) -> list[np.ndarray]:
    dice = np.random.default_rng(seed)
    return [dice.integers(0, classes, n).astype(np.uint16) for n in lengths]


def plain_forward(tokens, model) -> float:
    total, state = 0.0, model.start
    for t, token in enumerate(tokens):
        state = (state if t == 0 else state @ model.move) * model.emit[token]
        total += math.log(state.sum())
        state = state / state.sum()
    return total


def plain_counts(tokens, model):
    """Textbook forward-backward of one sequence."""
    n, k = len(tokens), len(model.start)
    alpha, beta = np.zeros((n, k)), np.ones((n, k))
    for t in range(n):
        alpha[t] = (model.start if t == 0 else alpha[t - 1] @ model.move) * model.emit[tokens[t]]
        alpha[t] /= alpha[t].sum()
    for t in range(n - 2, -1, -1):
        beta[t] = model.move @ (model.emit[tokens[t + 1]] * beta[t + 1])
        beta[t] /= beta[t].sum()
    gamma = alpha * beta
    gamma /= gamma.sum(1, keepdims=True)
    moves, emits = np.zeros((k, k)), np.zeros(model.emit.shape)
    for t in range(n - 1):
        xi = alpha[t][:, None] * model.move * (model.emit[tokens[t + 1]] * beta[t + 1])[None]
        moves += xi / xi.sum()
    for t in range(n):
        emits[tokens[t]] += gamma[t]
    return gamma[0], moves, emits


LENGTHS = [1, 2, 7, 8, 9, 17, 40, 41, 300, 33, 1, 16]


@pytest.mark.parametrize("chunk", [4, 9, 16, 1024])
@pytest.mark.parametrize("batch", [3, 4096])
def test_recursions_equal_textbook_ones(monkeypatch, chunk, batch):
    monkeypatch.setattr(hm, "CHUNK", chunk)
    monkeypatch.setattr(hm, "BATCH_CHUNKS", batch)
    model, tokens = random_model(), sequences(1, LENGTHS)
    assert np.allclose(hm.log_likelihood(tokens, model), [plain_forward(one, model) for one in tokens], rtol=1e-10)
    wanted = [sum(parts) for parts in zip(*[plain_counts(one, model) for one in tokens])]
    for found, right in zip(hm.expected_counts(tokens, model), wanted):
        assert np.allclose(found, right, rtol=1e-8, atol=1e-10)


def test_every_round_of_training_raises_the_likelihood():
    model, tokens = random_model(seed=5), sequences(6, [60] * 20)
    tokens = [np.where(np.arange(len(one)) % 4 < 2, one % 3, 5 + one % 3).astype(np.uint16) for one in tokens]
    last = -np.inf
    for _ in range(8):
        found = hm.log_likelihood(tokens, model).sum()
        assert found > last
        last = found
        starts, moves, emits = hm.expected_counts(tokens, model)
        model = hm.Model(starts / starts.sum(), moves / moves.sum(1, keepdims=True), (emits + 1e-12) / (emits + 1e-12).sum(0))


def words_of(text) -> list[str]:
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), ""]


def brute(rows):
    """(held out, tokens, known, N, base) of every row."""
    split = [words_of(text) for _, text in rows]
    out = [doc is not None and zlib.crc32(str(doc).encode()) % 7 == 2 for doc, _ in rows]
    counts = Counter(word for words, held in zip(split, out) if not held for word in words)
    n, v = sum(counts.values()), len(counts)
    return [
        (doc, held, len(words), sum(counts[w] > 0 for w in words), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words), 6))
        for (doc, _), words, held in zip(rows, split, out)
    ]


def rounded(rows):
    return sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in rows), key=repr)


@pytest.mark.parametrize(("head", "known"), [(4, 9), (5000, 5000), (3, 1)])
def test_counts_and_base_equal_brute_force(spark, documents, head, known):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    found = hm.score_documents(documents, head=head, known=known, states=2, rounds=1).collect()
    assert rounded(found) == sorted(brute(rows), key=repr)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in found)


def test_scores_are_the_likelihood_of_classes_and_of_words_in_them(spark, documents):
    rows = documents.select("doc_id", "text")
    found = {(r["doc_id"], r["n_tokens"], round(r["base_score"], 6)): r["score"] for r in hm.score_documents(rows, head=20, known=31, states=3, rounds=2).collect()}
    split = rows.selectExpr("doc_id", "text", "coalesce(crc32(cast(cast(doc_id as string) as binary)) % 7 = 2, false) held_out")
    counts = hm.token_counts(split.where("not held_out"))
    lexicon = hm.learn_lexicon(counts, 20, 31)
    assert lexicon.head == 20 < len(lexicon.words) <= 31
    model = hm.train(hm.encoded(split, lexicon).where("not held_out").repartition(5), lexicon, 3, 2)
    known = {r["word"]: r["n"] for r in counts.collect()}
    texts = [tuple(row) for row in rows.collect()]
    for (doc, text), (_, _, n_tokens, _, _, base) in zip(texts, brute(texts)):
        words = words_of(text)
        classes, inside = [], 0.0
        for word in words:
            if word in lexicon.words[: lexicon.head]:
                classes.append(lexicon.words.index(word))
                continue
            group = zlib.crc32(word[-3:].encode()) % hm.TAIL
            classes.append(lexicon.head + group)
            inside += math.log10((known.get(word, 0) + 1) / (lexicon.occurrences[group] + lexicon.kinds[group] + 1))
        wanted = plain_forward(classes, model) / math.log(10) + inside
        assert found[(doc, n_tokens, base)] == pytest.approx(wanted, rel=1e-5)


def test_class_chances_sum_to_one(spark, documents):
    counts = hm.token_counts(documents)
    lexicon = hm.learn_lexicon(counts, 10)
    rare = [r for r in counts.collect() if r["word"] not in lexicon.words[: lexicon.head]]
    groups = Counter()
    for r in rare:
        groups[zlib.crc32(r["word"][-3:].encode()) % hm.TAIL] += r["n"] + 1
    for group, n in groups.items():
        assert n == lexicon.occurrences[group] + lexicon.kinds[group]  # one more is left for an unknown word
    model = hm.first_model(lexicon)
    assert np.allclose(model.emit.sum(0), 1) and np.allclose(model.move.sum(1), 1)


def test_learns_kinds_of_text_for_held_out_ones(spark):
    dice = np.random.default_rng(3)
    kinds = [["ein", "der", "das", "haus", "wald", "see"], ["the", "a", "one", "house", "wood", "lake"]]
    rows = [(doc, " ".join(dice.choice(kinds[doc % 2], 30))) for doc in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    held = [r for r in hm.score_documents(df, states=3, rounds=8).collect() if r["held_out"]]
    gain = sum(r["score"] - r["base_score"] for r in held) / sum(r["n_tokens"] for r in held)
    assert held and gain > 0.22  # knowing the kind is worth log10(2) = 0.3 a word at most


def test_without_training_rows_and_without_rows(spark, nothing):
    assert hm.score_documents(nothing).collect() == []
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    df = spark.createDataFrame([(held, "some words"), (held, None)], "doc_id long, text string")
    found = hm.score_documents(df, rounds=1).collect()
    assert sorted((r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in found) == [(1, 0, 0, 0.0), (3, 0, 0, 0.0)]
    assert all(math.isfinite(r["score"]) for r in found)
