"""A hidden Markov language model over whole texts, trained by Baum-Welch on all training rows.

The states emit classes, and classes emit words. The most frequent words
(``HEAD``) have a class of their own; all others share ``TAIL`` classes by
their last letters, inside which a word has its smoothed share of the class's
occurrences. The counts of words grow with the corpus and stay in a table that
meets the texts in a join; only those of the ``KNOWN`` most frequent words, a
table of bounded size, are looked up in the tasks, so the join sees rare words
alone.

One step of the recursion takes the state distribution before a token,
multiplies it by the token's emissions and applies the transitions; every few
steps it is scaled to one, and the product of the factors is the likelihood. All texts of a batch are
cut into chunks of ``CHUNK`` tokens that go through the recursion side by
side. A chunk that is not the first of its text needs the distribution at its
start: the product of the step matrices of the chunks before gives it, so the
result is that of one pass over the whole text, whatever its length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordermill.llm.batches import slices
from ordermill.llm.folds import fold
from ordermill.llm.spans import split_words
from ordermill.sources.scratch import materialize

STATES = 8
HEAD = 8192  # words with a class of their own
KNOWN = 1 << 18  # words whose counts every task holds
KNOWN_BYTES = 64  # longer words are never among them, so the table stays below KNOWN * (KNOWN_BYTES + 8) bytes
BUCKETS = 16  # steps of the frequency scale for each doubling
TAIL = 512  # classes of all other words
ROUNDS = 5
PERSIST = 50  # weight of staying in a state before the first round
SLICE = 4 << 20  # text handled at once inside a task
CHUNK = 1024
RESCALE = 8  # tokens between two scalings; their chances multiply to far more than the least number
BATCH_CHUNKS = 4096  # chunks that go through the recursion side by side
FOLDS, HELD_OUT = 7, 2
END = ""  # the token after the last word of every text; no word is empty
FIXED = 1 << 24  # expected counts are added up as whole numbers of this fraction
SEED = 12


class Model(NamedTuple):
    start: np.ndarray  # states
    move: np.ndarray  # states x states, rows sum to one
    emit: np.ndarray  # classes x states, columns sum to one


# Counts and classes ----------------------------------------------------------------


def token_counts(documents: DataFrame) -> DataFrame:
    """``word``, ``n``: occurrences of every word and of the end of a text (empty word)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=SLICE):
                found = split_words(part.column("text"))
                counts = np.bincount(found.codes, minlength=len(found.names))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([found.names, pa.array([END], pa.string())]),
                        pa.array(np.append(counts, part.num_rows), pa.int64()),
                    ],
                    ["word", "n"],
                )

    texts = documents.selectExpr("cast(text as string) text")
    return texts.mapInArrow(work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def tail_class(word: Column) -> Column:
    """Class of a word that has none of its own: by a hash of its last three code points."""
    return (F.crc32(F.substring(word, -3, 3).cast("binary")) % TAIL).cast("int")


def _tail_classes(words: list[str]) -> np.ndarray:
    return np.fromiter((zlib.crc32(word[-3:].encode()) % TAIL for word in words), np.int64, len(words))


class Lexicon:
    """What every task knows: frequent words with their counts and classes, and the sizes of the tail classes.

    ``words``: most frequent first, the end of a text before all others; the first ``head`` have classes of their own.
    """

    def __init__(self, words: list[tuple[str, int]], head: int, total: int, distinct: int, occurrences: np.ndarray, kinds: np.ndarray) -> None:
        self.words = [word for word, _ in words]
        self.counts = np.array([n for _, n in words], np.int64)
        self.head, self.total, self.distinct = min(head, len(words)), total, distinct
        self.occurrences, self.kinds = occurrences, kinds  # of tail classes: all occurrences, distinct words
        self.classes = np.append(np.arange(self.head), self.head + _tail_classes(self.words[self.head :])).astype(np.int64)
        self.base = np.log10((self.counts + 1) / (total + distinct + 1))
        sizes = (occurrences + kinds + 1)[self.classes[self.head :] - self.head]
        self.inside = np.append(np.zeros(self.head), np.log10((self.counts[self.head :] + 1) / sizes))

    def class_counts(self) -> np.ndarray:
        return np.concatenate([self.counts[: self.head], self.occurrences]).astype(float) + 1

    def inside_tail(self, counts: Column, group: Column) -> Column:
        """log10 of a word's share of its class, one unknown word included."""
        sizes = F.array(*[F.lit(float(a + b + 1)) for a, b in zip(self.occurrences.tolist(), self.kinds.tolist())])
        return F.log10((counts + 1) / F.element_at(sizes, group + 1))


def learn_lexicon(counts: DataFrame, head: int = HEAD, known: int = KNOWN) -> Lexicon:
    """``counts``: the stored ``token_counts`` of the training rows."""
    short = counts.where((F.octet_length("word") <= KNOWN_BYTES) & (F.col("word") != END))
    step = F.floor(F.log2("n") * BUCKETS)
    steps = sorted(((row[0], row[1]) for row in short.groupBy(step).count().collect()), reverse=True)
    lowest, room = None, known - 1
    for value, size in steps:  # whole steps of the scale, as far as they fit
        room -= size
        if room < 0:
            break
        lowest = value
    often = short.where(step >= lowest).collect() if lowest is not None else []
    end = [(row["word"], row["n"]) for row in counts.where(F.col("word") == END).collect()] or [(END, 0)]
    words = end + sorted(((row["word"], row["n"]) for row in often), key=lambda one: (-one[1], one[0]))
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    sizes = counts.groupBy(tail_class(F.col("word")).alias("group")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds")).collect()
    occurrences, kinds = np.zeros(TAIL, np.int64), np.zeros(TAIL, np.int64)
    for row in sizes:
        occurrences[row["group"]], kinds[row["group"]] = row["n"], row["kinds"]
    own = [(word, n) for word, n in words[:head] if n]  # these are not in tail classes
    for group, (_, n) in zip(_tail_classes([word for word, _ in own]).tolist(), own):
        occurrences[group] -= n
        kinds[group] -= 1
    return Lexicon(words, head, int(totals[0]), int(totals[1]), occurrences, kinds)


def encoded(documents: DataFrame, lexicon: Lexicon) -> DataFrame:
    """One row per document: its classes, the chances of its known words, and its other words with their counts.

    ``uid`` numbers the rows of the written table; ids may repeat or be null.
    """
    known = pa.array(lexicon.words, pa.string())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, limit=SLICE):
                rows = part.num_rows
                found = split_words(part.column("text"))
                own = pc.fill_null(pc.index_in(found.names, known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
                rare_names = np.flatnonzero(own < 0)
                classes = lexicon.classes[own]
                classes[rare_names] = lexicon.head + _tail_classes(found.names.take(pa.array(rare_names)).to_pylist())
                ends = np.searchsorted(found.docs, np.arange(rows), side="right")
                tokens = np.insert(classes[found.codes], ends, 0).astype(np.uint16)  # the end of a text has class 0
                bounds = ends + np.arange(1, rows + 1)
                rare = own[found.codes] < 0
                words, docs = own[found.codes[~rare]], found.docs[~rare]
                counts = np.bincount(docs, minlength=rows) + int(lexicon.counts[0] > 0)
                base = np.bincount(docs, lexicon.base[words], minlength=rows) + lexicon.base[0]
                inside = np.bincount(docs, lexicon.inside[words], minlength=rows)
                pairs, times = np.unique(found.docs[rare] * len(found.names) + found.codes[rare], return_counts=True)
                size = max(1, len(found.names))
                cuts = pa.array(np.searchsorted(pairs // size, np.arange(rows + 1)).astype(np.int32))
                others = pa.StructArray.from_arrays([found.names.take(pa.array(pairs % size)), pa.array(times, pa.int64())], ["word", "times"])
                offsets = pa.py_buffer(np.append(0, 2 * bounds).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), part.column("held_out"), pa.array(bounds - np.append(0, bounds[:-1]), pa.int64()),
                        pa.Array.from_buffers(pa.binary(), rows, [None, offsets, pa.py_buffer(tokens.tobytes())]),
                        pa.array(counts, pa.int64()), pa.array(base, pa.float64()), pa.array(inside, pa.float64()),
                        pa.ListArray.from_arrays(cuts, others),
                    ],
                    ["doc_id", "held_out", "n_tokens", "classes", "known", "base", "inside", "rare"],
                )

    schema = (
        "doc_id long, held_out boolean, n_tokens long, classes binary, known long, base double, inside double,"
        " rare array<struct<word: string, times: long>>"
    )
    return documents.mapInArrow(work, schema).withColumn("uid", F.monotonically_increasing_id())


# Recursion --------------------------------------------------------------------------


def _emissions(model: Model, tokens: np.ndarray) -> np.ndarray:
    return model.emit.take(tokens, axis=0, mode="clip")


class Chunks:
    """Where the chunks of many texts lie in the joined tokens, longest chunks first."""

    def __init__(self, tokens: list[np.ndarray]) -> None:
        lengths = np.array([len(one) for one in tokens], np.int64)
        self.tokens = np.concatenate(tokens).astype(np.int64) if tokens else np.zeros(0, np.int64)
        per_text = -(-lengths // CHUNK)
        text = np.repeat(np.arange(len(tokens)), per_text)
        number = np.arange(len(text)) - (np.cumsum(per_text) - per_text)[text]
        sizes = np.minimum(CHUNK, lengths[text] - number * CHUNK)
        order = np.argsort(-sizes, kind="stable")
        self.text, self.number, self.sizes = text[order], number[order], sizes[order]
        self.starts = (np.cumsum(lengths) - lengths)[self.text] + self.number * CHUNK
        self.last = self.number == per_text[self.text] - 1
        self.place = np.empty(len(order), np.int64)  # of a chunk in text order
        self.place[order] = np.arange(len(order))

    def active(self, idx: np.ndarray) -> np.ndarray:
        """How many of the chunks ``idx`` (longest first) have more than t tokens, for every step t."""
        sizes = self.sizes[idx]
        return np.searchsorted(-sizes, -np.arange(int(sizes[0]) if len(sizes) else 0), side="left")

    def joints(self, model: Model) -> tuple[np.ndarray, np.ndarray]:
        """State distribution before every chunk, and the (scaled) chance of all that follows each one, by state."""
        states = len(model.start)
        before, after = np.tile(model.start, (len(self.text), 1)), np.ones((len(self.text), states))
        long = np.flatnonzero(~self.last | (self.number > 0))
        step = np.tile(np.eye(states), (len(long), 1, 1))
        starts = self.starts[long]
        for t, count in enumerate(self.active(long).tolist()):
            emit = _emissions(model, self.tokens[starts[:count] + t])
            moved = ((step[:count] * emit[:, None, :]).reshape(-1, states) @ model.move).reshape(count, -1)
            if t % RESCALE == RESCALE - 1:
                moved /= moved.sum(1, keepdims=True)
            step[:count] = moved.reshape(count, states, states)
        rank = np.full(len(self.text), -1)
        rank[long] = np.arange(len(long))
        in_order = self.place[rank[self.place] >= 0].tolist()  # chunks of long texts, text by text
        last = self.last.tolist()
        for chunk, following in zip(in_order, in_order[1:]):
            if not last[chunk]:
                found = before[chunk] @ step[rank[chunk]]
                before[following] = found / found.sum()
        for chunk, following in zip(in_order[-2::-1], in_order[:0:-1]):
            if not last[chunk]:
                found = step[rank[following]] @ after[following]
                after[chunk] = found / found.sum()
        return before, after


def log_likelihood(tokens: list[np.ndarray], model: Model) -> np.ndarray:
    """Natural logarithm of the chance of every class sequence, by the scaled forward recursion."""
    grid = Chunks(tokens)
    before, _ = grid.joints(model)
    total, ones = np.zeros(len(grid.text)), np.ones(len(model.start))
    for low in range(0, len(grid.text), BATCH_CHUNKS):
        idx = np.arange(low, min(low + BATCH_CHUNKS, len(grid.text)))
        state, starts, active = before[idx], grid.starts[idx], [*grid.active(idx).tolist(), 0]
        for t, (count, later) in enumerate(zip(active, active[1:])):
            state = (state[:count] * _emissions(model, grid.tokens[starts[:count] + t])) @ model.move
            scaled = 0 if t % RESCALE == RESCALE - 1 else later  # chunks that end here, or all
            if scaled < count:
                scale = state[scaled:] @ ones
                total[low + scaled : low + count] += np.log(scale)
                state[scaled:] /= scale[:, None]
    return np.bincount(grid.text, total, minlength=len(tokens))


def expected_counts(tokens: list[np.ndarray], model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected starts, transitions and emissions (classes x states) of the texts under the model."""
    grid, states = Chunks(tokens), len(model.start)
    before, after = grid.joints(model)
    starts, moves, emits = np.zeros(states), np.zeros((states, states)), np.zeros(model.emit.shape)
    back_move, ones = np.ascontiguousarray(model.move.T), np.ones(states)
    for low in range(0, len(grid.text), BATCH_CHUNKS):
        idx = np.arange(low, min(low + BATCH_CHUNKS, len(grid.text)))
        begins, last, active = grid.starts[idx], grid.last[idx], grid.active(idx).tolist()
        state, forward = before[idx], []  # forward: chance of the states before a token, times its emission
        for t, count in enumerate(active):
            seen = state[:count] * _emissions(model, grid.tokens[begins[:count] + t])
            if t % RESCALE == RESCALE - 1:
                seen /= (seen @ ones)[:, None]
            forward.append(seen)
            state = seen @ model.move
        follow, symbols, held = after[idx], [], []  # follow: chance of what comes after token t, by the next state
        for t in range(len(active) - 1, -1, -1):
            count, later = active[t], active[t + 1] if t + 1 < len(active) else 0
            symbol = grid.tokens[begins[:count] + t]
            reached = follow[:count] @ back_move
            seen = forward.pop()
            post = seen * reached
            share = 1 / (post @ ones)
            post *= share[:, None]
            symbols.append(symbol)
            held.append(post)
            share[later:][last[later:count]] = 0  # the last token of a text moves nowhere
            seen *= share[:, None]
            moves += seen.T @ follow[:count]
            reached *= _emissions(model, symbol)
            if t % RESCALE == 0:
                reached /= (reached @ ones)[:, None]
            follow[:count] = reached
        starts += held[-1][grid.number[idx] == 0].sum(0)
        symbol, post = np.concatenate(symbols), np.concatenate(held)
        for number in range(states):
            emits[:, number] += np.bincount(symbol, post[:, number], minlength=len(emits))
    return starts, moves * model.move, emits


# Training ------------------------------------------------------------------------------


def first_model(lexicon: Lexicon, states: int = STATES, seed: int = SEED) -> Model:
    """Every state has the corpus frequencies with its own fixed disturbance, and rarely changes at first.

    So the first rounds tell languages and kinds of text apart, the later ones what follows what.
    """
    dice = np.random.default_rng(seed)
    counts = lexicon.class_counts()
    emit = counts[:, None] * np.exp(dice.normal(0, 1, (len(counts), states)))
    move = dice.uniform(0.5, 1.5, (states, states)) + PERSIST * np.eye(states)
    return Model(np.full(states, 1 / states), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def _batches_of_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        for part in slices(batch, "classes", 2 << 20):
            yield part, [np.frombuffer(one, np.uint16) for one in part.column("classes").to_pylist()]


def _round(training: DataFrame, model: Model) -> np.ndarray:
    """Expected counts of all rows: one row per start, state and class, summed over partitions in whole numbers."""
    states = len(model.start)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((1 + states + len(model.emit), states))
        for _, tokens in _batches_of_tokens(batches):
            starts, moves, emits = expected_counts(tokens, model)
            total += np.vstack([starts, moves, emits])
        used = np.flatnonzero(total.any(1))
        whole = np.rint(total[used] * FIXED).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), *[pa.array(whole[:, state], pa.int64()) for state in range(states)]],
            ["line", *[f"s{state}" for state in range(states)]],
        )

    columns = ", ".join(f"s{state} long" for state in range(states))
    parts = training.select("classes").mapInArrow(work, f"line long, {columns}")
    summed = parts.groupBy("line").agg(*[F.sum(F.col(f"s{state}").cast("decimal(38,0)")).alias(f"s{state}") for state in range(states)])
    result = np.zeros((1 + states + len(model.emit), states))
    for row in summed.collect():  # as many rows as the model has lines
        result[row["line"]] = [float(value) / FIXED for value in row[1:]]
    return result


def train(training: DataFrame, lexicon: Lexicon, states: int = STATES, rounds: int = ROUNDS) -> Model:
    """Baum-Welch over all rows of ``training`` (from ``encoded``); every round sees every token.

    Emissions are smoothed with a small share of the corpus frequencies, so
    no token of any text has the chance zero.
    """
    model = first_model(lexicon, states)
    corpus = lexicon.class_counts() / lexicon.class_counts().sum()
    for _ in range(rounds):
        counts = _round(training, model)
        starts, moves, emits = counts[0] + 0.1, counts[1 : 1 + states] + 0.1, counts[1 + states :]
        emits = emits + corpus[:, None] * (1 + 0.01 * emits.sum(0))
        model = Model(starts / starts.sum(), moves / moves.sum(1, keepdims=True), emits / emits.sum(0))
    return model


def score_documents(documents: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT, head: int = HEAD, known: int = KNOWN,
                    states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` of every text.

    Learned from the rows whose crc32 of the id modulo ``folds`` is not
    ``held_out`` (a null id belongs to no fold and is learned from). A null
    text is an empty one, its end is its only token. Without training rows
    all words are unknown. Rows with equal ids are scored one by one; extra
    columns are not read.
    """
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(fold(F.col("doc_id"), folds) == held_out, F.lit(False)).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    counts = materialize(token_counts(rows.where("not held_out")), "tokens")
    lexicon = learn_lexicon(counts, head, known)
    stored = materialize(encoded(rows, lexicon), "classes")
    model = train(stored.where("not held_out"), lexicon, states, rounds)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, tokens in _batches_of_tokens(batches):
            found = log_likelihood(tokens, model) / np.log(10)
            names = ["uid", "doc_id", "held_out", "n_tokens", "known", "base", "inside"]
            yield pa.RecordBatch.from_arrays([*[part.column(name) for name in names], pa.array(found)], [*names, "latent"])

    columns = "uid long, doc_id long, held_out boolean, n_tokens long, known long, base double, inside double, latent double"
    scored = stored.drop("rare").mapInArrow(work, columns)
    rare = stored.select("uid", F.explode("rare").alias("rare")).select("uid", "rare.word", "rare.times")
    n = F.coalesce("n", F.lit(0))
    chances = rare.join(counts, "word", "left").select(
        "uid",
        F.when(F.col("n") > 0, F.col("times")).otherwise(0).alias("known"),
        (F.col("times") * F.log10((n + 1) / F.lit(float(lexicon.total + lexicon.distinct + 1)))).alias("base"),
        (F.col("times") * lexicon.inside_tail(n, tail_class(F.col("word")))).alias("inside"),
    )
    tails = chances.groupBy("uid").agg(F.sum("known").alias("_known"), F.sum("base").alias("_base"), F.sum("inside").alias("_inside"))
    zero = F.lit(0)
    return scored.join(tails, "uid", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("_known", zero)).alias("n_known"),
        F.lit(lexicon.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("_base", zero)).alias("base_score"),
        (F.col("latent") + F.col("inside") + F.coalesce("_inside", zero)).alias("score"),
    )
