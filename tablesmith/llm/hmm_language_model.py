"""Language-model scoring with a hidden Markov model.

A text is its words and one end. The model emits one symbol per step: the ``vocabulary`` most frequent
training words and the end have a symbol each, all other words the symbol of their length. A rarer
word's probability is its symbol's times ``(c + 1) / (n + v + 1)`` with its own training count ``c`` and
the tokens ``n`` and distinct words ``v`` of that symbol, so unseen words have one share together and
everything sums to one.

Training is Baum-Welch: each task runs the scaled forward and backward recursions over its texts and
returns expected counts by symbol, which are summed by symbol. Every pass goes through all training
texts. The first one takes them in disjoint shares, one after the other, and after each share makes the
model anew from the counts of all shares so far (incremental EM), to find the states; the last one takes
all of them under one model. Word counts cover all training texts and are joined to the rare words of
each text, of which none has more than 1/``vocabulary`` of the tokens. Scoring is the forward recursion
over each whole text: its exact likelihood.

Texts run through the recursions side by side, so a step is one matrix product for all of them.

Defined cases: a NULL or empty text is the end alone; without training texts all words are unseen;
repeated rows count and are scored each; a NULL ``doc_id`` is scored like any other; other columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import Words, binary_array, column_of, slices, written

_WORDS = Words()
LENGTHS = 16
#: Words that are counted together before they leave a task, and tokens whose states are held at once.
GATHERED, HELD = 4_000_000, 400_000


@dataclass(frozen=True)
class Settings:
    states: int = 8
    vocabulary: int = 32_768
    shares: tuple[int, ...] = (8, 1)  # disjoint shares of all training texts, by pass
    prior: float = 20.0
    stay: float = 0.9
    seed: int = 5


@dataclass(frozen=True)
class Vocabulary:
    """Frequent words by hash, sorted, and what is known of the others by length."""

    hashes: np.ndarray
    counts: np.ndarray
    rare_tokens: np.ndarray
    rare_words: np.ndarray
    texts: int
    tokens: int
    distinct: int

    @property
    def end(self) -> int:
        return len(self.hashes) + LENGTHS

    def symbols(self, words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        rare = len(self.hashes) + _length_class(lengths)
        if not len(self.hashes):
            return rare
        at = np.minimum(np.searchsorted(self.hashes, words), len(self.hashes) - 1)
        return np.where(self.hashes[at] == words, at, rare)

    def totals(self) -> np.ndarray:
        """Training tokens of every symbol."""
        return np.concatenate([self.counts, self.rare_tokens, [self.texts]]).astype(float)


@dataclass(frozen=True)
class Model:
    begin: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # a row per symbol


def _length_class(lengths: np.ndarray) -> np.ndarray:
    return np.minimum(lengths - 1, LENGTHS - 1)


def _tally(words: list[np.ndarray], kinds: list[np.ndarray]) -> pa.RecordBatch:
    found, at, n = np.unique(np.concatenate(words), return_index=True, return_counts=True)
    kinds = np.concatenate(kinds)[at]
    return pa.RecordBatch.from_arrays(
        [pa.array(found.view(np.int64)), pa.array(kinds.astype(np.int32)), pa.array(n)], names=["word", "kind", "c"]
    )


def word_counts(docs: DataFrame) -> DataFrame:
    """``word`` (hash), ``kind`` (by length) and ``c`` over ``text``."""

    def count(batches):
        words, kinds, size = [], [], 0
        for batch in batches:
            for _, data, offsets in slices(column_of(batch, "text")):
                found, _, lengths = _WORDS.measured(data, offsets)
                words.append(found)
                kinds.append(_length_class(lengths))
                size += len(found)
                if size >= GATHERED:
                    yield _tally(words, kinds)
                    words, kinds, size = [], [], 0
        if size:
            yield _tally(words, kinds)

    counts = docs.select("text").mapInArrow(count, "word long, kind int, c long")
    return counts.groupBy("word").agg(F.min("kind").alias("kind"), F.sum("c").alias("c"))


def vocabulary(counts: DataFrame, texts: int, s: Settings) -> Vocabulary:
    # Counts fall into at most 512 steps; whole steps of frequent words fit in the vocabulary.
    step = F.floor(F.log2(F.col("c")) * 8).cast("int")
    steps = counts.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect()
    total, least = 0, None
    for row in sorted(steps, key=lambda r: -r["step"]):
        total += row["n"]
        if total > s.vocabulary:
            break
        least = row["step"]
    marked = counts.withColumn("frequent", F.lit(False) if least is None else step >= least)
    table = marked.where("frequent").select("word", "c").toArrow()
    hashes, c = table["word"].to_numpy().view(np.uint64), table["c"].to_numpy()
    order = np.argsort(hashes)
    tokens, distinct = np.zeros(LENGTHS), np.zeros(LENGTHS)
    rare = marked.where(~F.col("frequent")).groupBy("kind").agg(F.sum("c").alias("n"), F.count("*").alias("v"))
    for row in rare.collect():
        tokens[row["kind"]], distinct[row["kind"]] = row["n"], row["v"]
    everything = int(c.sum() + tokens.sum()) + texts
    words = int(len(c) + distinct.sum()) + (texts > 0)
    return Vocabulary(hashes[order], c[order], tokens, distinct, texts, everything, words)


def symbol_texts(docs: DataFrame, known) -> DataFrame:
    """``carry`` columns and, per text, ``symbols`` (uint16) with the end, and the hashes of its rare words."""
    schema = docs.drop("text").schema

    def convert(batches):
        v = known.value
        for batch in batches:
            symbols, rare = [], []
            for _, data, offsets in slices(column_of(batch, "text")):
                words, bounds, lengths = _WORDS.measured(data, offsets)
                found = v.symbols(words, lengths)
                for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                    symbols.append(np.append(found[a:b], v.end).astype("<u2").tobytes())
                    rare.append(words[a:b][found[a:b] >= len(v.hashes)].tobytes())
            rest = [column_of(batch, f.name) for f in schema.fields]
            yield pa.RecordBatch.from_arrays(
                [*rest, binary_array(symbols), binary_array(rare)], names=[*schema.names, "symbols", "rare"]
            )

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    columns = [*schema.names, "text"]
    return docs.select(*columns).mapInArrow(convert, f"{fields}, symbols binary, rare binary")


def _groups(column: pa.Array, limit: int | None):
    """Texts as one array of symbols with their starts, longest first, about ``limit`` symbols at once."""
    texts = [np.frombuffer(x.as_buffer(), "<u2") for x in column]
    order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
    first = 0
    while first < len(order):
        last, size = first, 0
        while last < len(order) and (last == first or limit is None or size + len(texts[order[last]]) <= limit):
            size += len(texts[order[last]])
            last += 1
        rows = order[first:last]
        lengths = np.array([len(texts[k]) for k in rows])
        yield rows, np.concatenate([texts[k] for k in rows]), np.cumsum(lengths) - lengths, lengths
        first = last


def _active(lengths: np.ndarray) -> np.ndarray:
    """How many texts, longest first, have each place."""
    return np.searchsorted(-lengths, -np.arange(lengths[0]), "left")


def log_likelihood(m: Model, symbols, starts, lengths) -> np.ndarray:
    """Natural logarithm of each text's probability, by the scaled forward recursion."""
    total, n = np.zeros(len(starts)), len(starts)
    state = np.broadcast_to(m.begin, (n, len(m.begin)))
    for step, n in enumerate(_active(lengths)):
        state = (state[:n] if step == 0 else state[:n] @ m.move) * m.emit[symbols[starts[:n] + step]]
        scale = state.sum(1)
        total[:n] += np.log(scale)
        state = state / scale[:, None]
    return total


def expected_counts(m: Model, symbols, starts, lengths) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Baum-Welch counts of beginnings, moves and, by symbol, states."""
    k, active = len(m.begin), _active(lengths)
    emit = m.emit[symbols]
    ahead, scales = np.empty((len(symbols), k)), np.empty(len(symbols))
    state = np.broadcast_to(m.begin, (len(starts), k))
    for step, n in enumerate(active):
        at = starts[:n] + step
        state = (state[:n] if step == 0 else state[:n] @ m.move) * emit[at]
        scales[at] = scale = state.sum(1)
        ahead[at] = state = state / scale[:, None]
    # What follows a place, emission included, for each place but the first of a text.
    after = np.empty((len(symbols), k))
    posterior = ahead.copy()
    back = np.ones((len(starts), k))
    for step in range(len(active) - 1, -1, -1):
        n = active[step]
        at = starts[:n] + step
        posterior[at] *= back[:n]
        after[at] = emit[at] * back[:n] / scales[at][:, None]
        back[:n] = after[at] @ m.move.T
    first = np.zeros(len(symbols), bool)
    first[starts] = True
    inner = np.flatnonzero(~first)
    moves = m.move * (ahead[inner - 1].T @ after[inner])
    by_symbol = np.stack([np.bincount(symbols, posterior[:, j], len(m.emit)) for j in range(k)], 1)
    return posterior[starts].sum(0), moves, by_symbol


def _first_model(v: Vocabulary, s: Settings) -> Model:
    """States with random preferences among the symbols, and a will to stay."""
    k, draw = s.states, np.random.default_rng(s.seed)
    usual = v.totals() + 1
    emit = usual[:, None] * draw.gamma(1.0, 1.0, (len(usual), k))
    move = np.full((k, k), (1 - s.stay) / max(k - 1, 1))
    np.fill_diagonal(move, s.stay)
    return Model(np.full(k, 1 / k), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def train(texts: DataFrame, v: Vocabulary, s: Settings) -> Model:
    """``texts``: ``symbols`` and ``draw``, a hash that deals texts to shares. In a pass with as many
    shares as the one before, a share's counts take the place of its old ones."""
    spark, model = texts.sparkSession, _first_model(v, s)
    usual = (v.totals() + 1) / (v.totals() + 1).sum()
    k = s.states
    schema = "symbol int, " + ", ".join(f"c{j} double" for j in range(k))
    kept = []  # a number per symbol and state, by share
    for number, share in ((n, i) for n in s.shares for i in range(n)):
        if len(kept) != number:
            kept = [0.0] * number
        shared = spark.sparkContext.broadcast(model)  # a number per symbol and state

        def count(batches, shared=shared):
            m = shared.value
            begin, move, emit = np.zeros(k), np.zeros((k, k)), np.zeros((len(m.emit), k))
            for batch in batches:
                for _, symbols, starts, lengths in _groups(column_of(batch, "symbols"), HELD):
                    a, b, c = expected_counts(m, symbols, starts, lengths)
                    begin, move, emit = begin + a, move + b, emit + c
            used = np.flatnonzero(emit.any(1))
            # Symbols below zero: -1 for beginnings, -2 - i for moves from state i.
            names = np.concatenate([used, [-1], -2 - np.arange(k)]).astype(np.int32)
            rows = np.concatenate([emit[used], begin[None], move])
            yield pa.RecordBatch.from_arrays(
                [pa.array(names), *[pa.array(rows[:, j]) for j in range(k)]],
                names=["symbol", *[f"c{j}" for j in range(k)]],
            )

        part = texts.where(F.pmod("draw", F.lit(number)) == share) if number > 1 else texts
        sums = part.select("symbols").mapInArrow(count, schema).groupBy("symbol")
        found = sums.agg(*[F.sum(f"c{j}").alias(f"c{j}") for j in range(k)]).toArrow()
        shared.destroy()
        symbol = found["symbol"].to_numpy()
        rows = np.stack([found[f"c{j}"].to_numpy() for j in range(k)], 1).reshape(-1, k)
        # The moves, the beginnings and the symbols' states below each other.
        counts = np.zeros((k + 1 + len(usual), k))
        counts[np.where(symbol < -1, -2 - symbol, symbol + k + 1)] = rows
        kept[share] = counts
        counts = sum(kept)
        begin, move = 1 + counts[k], np.full((k, k), 0.1) + np.eye(k) + counts[:k]
        emit = s.prior * usual[:, None] + counts[k + 1 :]
        model = Model(begin / begin.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))
    return model


def _rare_pairs(texts: DataFrame) -> DataFrame:
    """``row, word, n`` of each text's rare words."""

    def pairs(batches):
        for batch in batches:
            rows, words = np.array(column_of(batch, "row")), column_of(batch, "rare")
            for first in range(0, len(rows), 500):
                parts = [np.frombuffer(x.as_buffer(), np.uint64) for x in words.slice(first, 500)]
                at = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
                values = np.concatenate(parts)
                order = np.lexsort((values, at))
                at, values = at[order], values[order]
                new = np.ones(len(at), bool)
                new[1:] = (values[1:] != values[:-1]) | (at[1:] != at[:-1])
                begins = np.flatnonzero(new)
                n = np.diff(np.append(begins, len(at)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[first + at[begins]]), pa.array(values[begins].view(np.int64)), pa.array(n)],
                    names=["row", "word", "n"],
                )

    return texts.select("row", "rare").mapInArrow(pairs, "row long, word long, n long")


def scored(docs: DataFrame, train_on, settings: Settings | None = None) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` of every whole text, in log10.

    ``train_on`` is a condition on ``doc_id``. ``base_score`` is the unigram model with one added to
    every count.
    """
    s = settings or Settings()
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    learnt = source.where(train_on)
    counts, _ = written(word_counts(learnt), "word-counts")
    v = vocabulary(counts, learnt.count(), s)
    known = spark.sparkContext.broadcast(v)  # `vocabulary` words
    marked = source.select(
        "doc_id", F.monotonically_increasing_id().alias("row"), train_on.alias("learnt"),
        F.xxhash64("doc_id", "text").alias("draw"), "text",
    )
    texts, _ = written(symbol_texts(marked, known), "symbols")
    model = train(texts.where("learnt"), v, s)

    joined = _rare_pairs(texts).join(counts.select("word", "c"), "word", "left")
    c = F.coalesce("c", F.lit(0))
    rare = joined.groupBy("row").agg(
        F.sum(F.col("n") * F.log10(c + 1)).alias("rare_score"),
        F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("rare_known"),
    )
    shared = spark.sparkContext.broadcast((model, v))

    def score(batches):
        model, v = shared.value
        frequent = len(v.hashes)
        # Of each symbol: the part of the base that needs no join, the rare words' share, whether it is known.
        base = np.concatenate([np.log10(v.counts + 1), np.zeros(LENGTHS), [np.log10(v.texts + 1)]])
        share = np.zeros(v.end + 1)
        share[frequent : v.end] = -np.log10(v.rare_tokens + v.rare_words + 1)
        sure = np.concatenate([np.ones(frequent), np.zeros(LENGTHS), [v.texts > 0]])
        each = np.log10(v.tokens + v.distinct + 1)
        for batch in batches:
            out = np.zeros((len(batch), 4))
            for rows, symbols, starts, lengths in _groups(column_of(batch, "symbols"), None):
                total = log_likelihood(model, symbols, starts, lengths) / np.log(10)
                sums = [np.add.reduceat(x[symbols], starts) for x in (base, share, sure)]
                out[rows] = np.stack([lengths, sums[2], sums[0] - lengths * each, total + sums[1]], 1)
            yield pa.RecordBatch.from_arrays(
                [column_of(batch, "doc_id"), column_of(batch, "row"), pa.array(out[:, 0].astype(np.int64)),
                 pa.array(out[:, 1].astype(np.int64)), pa.array(out[:, 2]), pa.array(out[:, 3])],
                names=["doc_id", "row", "n_tokens", "known", "base", "total"],
            )

    whole = texts.select("doc_id", "row", "symbols").mapInArrow(
        score, "doc_id long, row long, n_tokens long, known long, base double, total double"
    )
    more = F.coalesce("rare_score", F.lit(0.0))
    return whole.join(rare, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(v.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"),
        (F.col("total") + more).alias("score"),
    )
