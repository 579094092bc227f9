"""Toxicity: logistic regression over hashed words, word pairs and skip pairs, fitted by
FTRL-proximal.

Each coordinate has its own learning rate and an L1 bound below which its weight is exactly zero, so
the fitted model is a short list of weights that is broadcast. Only features that several documents
of the sample have get a coordinate. Training is done in rounds: the sample is dealt to a fixed number of shards, each shard runs FTRL over its rows from the shared state, and
the shards' changes of a coordinate are added up.

A document's features are the distinct hashed n-grams of its whole text; case of A to Z and ASCII
punctuation don't count. Defined cases: a NULL, empty or wordless text has the bias alone; without
labelled rows every score is 0.5; repeated rows are scored alike; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F, types as T

from .labelled import labelled_sample
from .shared import Words, binary_array, column_of, give_back, grams, slices

#: Bytes that are no part of a word: ASCII but digits and letters.
SEPARATORS = bytes(range(0x30)) + bytes(range(0x3A, 0x41)) + bytes(range(0x5B, 0x61)) + bytes(range(0x7B, 0x80))
_WORDS = Words(SEPARATORS)
#: Places whose changes are one row.
CHANGES = 1 << 14


@dataclass(frozen=True)
class Settings:
    bits: int = 24  # features are hashed to 2**bits coordinates
    min_docs: int = 3  # in how many documents of the sample a feature must be
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 6.0
    l2: float = 0.02
    shards: int = 2
    rounds: int = 6
    max_rows: int = 20_000  # labelled rows to learn from


@dataclass(frozen=True)
class Model:
    bias: float
    index: np.ndarray
    weight: np.ndarray
    bits: int

    def found(self, index: np.ndarray, seen: np.ndarray) -> np.ndarray:
        """Which of the coordinates have a weight. ``seen`` is ``self.seen()``."""
        maybe = np.flatnonzero(seen[index >> (self.bits - 16)])
        at = np.minimum(np.searchsorted(self.index, index[maybe]), max(len(self.index) - 1, 0))
        return maybe[self.index[at] == index[maybe]] if len(self.index) else maybe[:0]

    def seen(self) -> np.ndarray:
        out = np.zeros(1 << 16, bool)
        out[self.index >> (self.bits - 16)] = True
        return out


def features(data: np.ndarray, offsets: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates of words, pairs and skip pairs of a run of texts, and each one's text."""
    words, bounds = _WORDS.hashed(data, offsets)
    pairs, pair_bounds = grams(words, bounds, 2, 100)
    # A skip pair leaves out one word: pairs of the first and third word.
    lengths = np.maximum(np.diff(bounds) - 2, 0)
    skip_bounds = np.concatenate([[0], np.cumsum(lengths)])
    at = np.arange(skip_bounds[-1]) + np.repeat(bounds[:-1] - skip_bounds[:-1], lengths)
    skips, _ = grams(np.stack([words[at], words[at + 2]], 1).ravel(), np.array([0, 2 * len(at)]), 2, 200)
    texts = np.arange(len(offsets) - 1)
    index = np.concatenate([words, pairs, skips[::2]]) >> np.uint64(64 - bits)
    text = np.concatenate([np.repeat(texts, np.diff(b)) for b in (bounds, pair_bounds, skip_bounds)])
    return index.astype(np.int64), text


def _step(s: Settings, z, n, index):
    zi = z[index]
    scale = (s.beta + np.sqrt(n[index])) / s.alpha + s.l2
    return np.where(np.abs(zi) <= s.l1, 0.0, (np.sign(zi) * s.l1 - zi) / scale)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _distinct(text: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Each text's coordinates once: text in the upper half, coordinate in the lower."""
    return np.unique(text << 32 | index)


def _coordinates(rows: DataFrame, s: Settings) -> np.ndarray:
    """The coordinates that get a state, sorted. Their number is bounded by the sample's."""

    def every(batches):
        for batch in batches:
            for _, data, offsets in slices(column_of(batch, "text")):
                index, text = features(data, offsets, s.bits)
                found, n = np.unique(_distinct(text, index) & 0xFFFFFFFF, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], names=["at", "n"])
        give_back()

    counts = rows.select("text").mapInArrow(every, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    return np.sort(counts.where(F.col("n") >= s.min_docs).select("at").toArrow()["at"].to_numpy())


def _places(rows: DataFrame, shared, s: Settings) -> DataFrame:
    """``label`` and each text's places in the shared list of coordinates, in the order of ``rows``."""

    def place(batches):
        known = shared.value
        for batch in batches:
            labels = column_of(batch, "label")
            for first, data, offsets in slices(column_of(batch, "text")):
                pair = _distinct(*features(data, offsets, s.bits)[::-1])
                index = pair & 0xFFFFFFFF
                found = np.searchsorted(known, index)
                hit = np.append(known, -1)[found] == index
                cuts = np.searchsorted(pair[hit] >> 32, np.arange(len(offsets)))
                places = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(found[hit], pa.int32()))
                yield pa.RecordBatch.from_arrays([labels.slice(first, len(places)), places], names=["label", "places"])
        give_back()

    return rows.mapInArrow(place, "label int, places array<int>")


def _round(rows: DataFrame, shared, s: Settings) -> DataFrame:
    """Changes of ``z`` and ``n``, summed over shards, in blocks of ``CHANGES`` places in the list of
    coordinates. The last place is the bias. ``rows`` are those of ``_places``."""

    def learn(batches):
        z0, n0 = shared.value
        z, n = z0.astype(float), n0.astype(float)
        for batch in batches:
            labels, lists = np.array(column_of(batch, "label")), column_of(batch, "places")
            places, cuts = lists.values.to_numpy(), lists.offsets.to_numpy()
            for k, label in enumerate(labels):
                at = np.append(places[cuts[k] : cuts[k + 1]], len(z) - 1)
                w = _step(s, z, n, at)
                w[-1] = -z[-1] / ((s.beta + np.sqrt(n[-1])) / s.alpha + s.l2)
                g = _sigmoid(w.sum()) - label
                z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / s.alpha * w
                n[at] += g * g
        for block, first in enumerate(range(0, len(z), CHANGES)):
            part = slice(first, first + CHANGES)
            dz, dn = (binary_array([x.tobytes()]) for x in (z[part] - z0[part], n[part] - n0[part]))
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), dz, dn], names=["block", "dz", "dn"])
        give_back()

    def add(shards):
        total = (
            sum(np.frombuffer(x.as_buffer(), float) for x in shards[name].combine_chunks()).tobytes() for name in ("dz", "dn")
        )
        return pa.table([shards["block"].slice(0, 1), *map(binary_array, ([x] for x in total))], names=["block", "dz", "dn"])

    schema = "block int, dz binary, dn binary"
    return rows.mapInArrow(learn, schema).groupBy("block").applyInArrow(add, schema)


def fit(docs: DataFrame, labels: DataFrame, label: str, learn_from, settings: Settings | None = None) -> Model:
    """Learn from labelled documents; ``learn_from`` is a condition on ``doc_id``."""
    s = settings or Settings()
    sample = labelled_sample(docs, labels, label, learn_from, s.max_rows)
    dealt = (
        sample.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(s.shards)).cast("int"))
        .repartitionById(s.shards, "shard")
        .sortWithinPartitions(F.xxhash64("doc_id", F.lit("order")), "doc_id", "text")
        .select("text", "label")
    )
    # The sample, some megabytes, is read twice; its places once more by each round, a shard by one task.
    texts = dealt.persist(StorageLevel.DISK_ONLY)
    context, rows = texts.sparkSession.sparkContext, None
    try:
        known = _coordinates(texts, s)
        coordinates = context.broadcast(known)
        rows = _places(texts, coordinates, s).persist(StorageLevel.DISK_ONLY)
        z, n = np.zeros(len(known) + 1, np.float32), np.zeros(len(known) + 1, np.float32)
        share = rows.agg(F.avg("label")).first()[0]
        texts.unpersist()
        if share is not None:  # the bias begins at the share of label 1
            share = min(max(share, 0.001), 0.999)
            z[-1] = -np.log(share / (1 - share)) * (s.beta / s.alpha + s.l2)
        for _ in range(s.rounds):
            shared = context.broadcast((z, n))
            changes = _round(rows, shared, s).toArrow()  # two numbers per coordinate
            shared.destroy()
            for block, dz, dn in zip(*(changes[name] for name in ("block", "dz", "dn")), strict=True):
                part = slice(block.as_py() * CHANGES, (block.as_py() + 1) * CHANGES)
                z[part] += np.frombuffer(dz.as_buffer(), float)
                n[part] += np.frombuffer(dn.as_buffer(), float)
        coordinates.destroy()
    finally:
        texts.unpersist()
        if rows is not None:
            rows.unpersist()
    w = _step(s, z, n, np.arange(len(known)))
    used = np.flatnonzero(w)
    bias = -z[-1] / ((s.beta + np.sqrt(n[-1])) / s.alpha + s.l2)
    return Model(float(bias), known[used], w[used], s.bits)


def toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """All rows of ``doc_id, text`` as ``doc_id, score``."""
    return docs.select("doc_id", "text").mapInArrow(_scorer(docs, model, False), "doc_id long, score double")


def with_toxicity(docs: DataFrame, model: Model, score: str) -> DataFrame:
    """``docs`` with one more column."""
    schema = T.StructType([*docs.schema.fields, T.StructField(score, T.DoubleType())])
    return docs.mapInArrow(_scorer(docs, model, True, score), schema)


def _scorer(docs: DataFrame, model: Model, whole: bool, name: str = "score"):
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        model = shared.value
        seen = model.seen()
        for batch in batches:
            for first, data, offsets in slices(column_of(batch, "text")):
                index, text = features(data, offsets, model.bits)
                hit = model.found(index, seen)
                pair = _distinct(text[hit], index[hit])
                weight = model.weight[np.searchsorted(model.index, pair & 0xFFFFFFFF)] if len(pair) else None
                total = np.bincount(pair >> 32, weight, len(offsets) - 1)
                scores = pa.array(_sigmoid(total + model.bias))
                some = batch.slice(first, len(scores))
                if whole:
                    names = [*batch.schema.names, name]
                    yield pa.RecordBatch.from_arrays([*some.columns, scores], names=names)
                else:
                    ids = column_of(some, "doc_id").cast(pa.int64())
                    yield pa.RecordBatch.from_arrays([ids, scores], names=["doc_id", "score"])
        give_back()

    return score


def acceptable(docs: DataFrame, model: Model, limit: float = 0.7) -> DataFrame:
    """``docs`` but those whose score reaches ``limit``."""
    name = "__toxicity"
    return with_toxicity(docs, model, name).where(F.col(name) < limit).drop(name)
