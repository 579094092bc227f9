from __future__ import annotations

import itertools
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablesmith.llm import hmm_language_model as m


def model(k=3, symbols=5, seed=1):
    draw = np.random.default_rng(seed)
    begin, move, emit = draw.random(k), draw.random((k, k)), draw.random((symbols, k))
    return m.Model(begin / begin.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def joined(texts):
    texts = sorted((np.array(t) for t in texts), key=len, reverse=True)
    lengths = np.array([len(t) for t in texts])
    return np.concatenate(texts), np.cumsum(lengths) - lengths, lengths


def paths(h, text):
    """The probability of every path of states."""
    for path in itertools.product(range(len(h.begin)), repeat=len(text)):
        p = h.begin[path[0]]
        for a, b in itertools.pairwise(path):
            p *= h.move[a, b]
        yield path, p * math.prod(h.emit[x, s] for x, s in zip(text, path, strict=True))


def test_likelihood_is_the_sum_over_all_paths():
    h, texts = model(), [[0, 1, 2, 4], [3, 3], [4]]
    found = m.log_likelihood(h, *joined(texts))
    assert np.allclose(np.exp(found), [sum(p for _, p in paths(h, t)) for t in texts])


def test_expected_counts_are_those_over_all_paths():
    h, texts = model(), [[0, 1, 2, 4], [3, 3, 1], [4]]
    begin, move, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    for t in texts:
        total = sum(p for _, p in paths(h, t))
        for path, p in paths(h, t):
            begin[path[0]] += p / total
            for a, b in itertools.pairwise(path):
                move[a, b] += p / total
            for x, s in zip(t, path, strict=True):
                emit[x, s] += p / total
    for found, expected in zip(m.expected_counts(h, *joined(texts)), (begin, move, emit), strict=True):
        assert np.allclose(found, expected)


def test_scores(spark, awkward, nothing):
    settings = m.Settings(states=3, vocabulary=500, shares=(1, 1))
    found = m.scored(awkward, F.col("doc_id") != 8, settings).collect()
    assert len(found) == awkward.count() and m.scored(nothing, F.lit(True), settings).collect() == []
    split = lambda t: [w for w in "".join(c if ord(c) > 127 else c.lower() for c in t or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    learnt = [r for r in awkward.collect() if r.doc_id not in (8, None)]
    counts = Counter(w for r in learnt for w in split(r.text))
    n, v = sum(counts.values()) + len(learnt), len(counts) + 1
    for r in awkward.collect():
        tokens = split(r.text)
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens) + math.log10((len(learnt) + 1) / (n + v + 1))
        mine = [x for x in found if x.doc_id == r.doc_id]
        assert mine and all(x.n_tokens == len(tokens) + 1 and x.train_tokens == n for x in mine)
        assert all(x.n_known == sum(counts[w] > 0 for w in tokens) + 1 for x in mine)
        assert all(x.base_score == pytest.approx(base) and x.score < 0 for x in mine)


def test_nothing_learnt(spark, awkward):
    found = m.scored(awkward, F.lit(False), m.Settings(states=2, shares=(1,))).collect()
    assert {r.train_tokens for r in found} == {0} and {r.n_known for r in found} == {0}
    assert all(r.base_score == 0 for r in found)


def test_better_than_its_base_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = m.scored(docs, F.col("doc_id") % 7 != 2).where("doc_id % 7 = 2").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > held[1]


def test_every_pass_takes_all_training_texts(spark):
    texts = [[0, 1, 2, 18], [2, 2, 18], [18], [1, 0, 1, 0, 18], [17, 2, 18], [0, 18], [1, 1, 16, 18]]
    rows = [(draw, np.array(t, "<u2").tobytes()) for draw, t in enumerate(texts, -3)]
    counted = np.bincount(np.concatenate(texts), minlength=19)
    v = m.Vocabulary(np.arange(2, dtype=np.uint64), counted[:2], counted[2:18], counted[2:18] > 0, len(texts), 25, 6)
    for shares in ((3,), (3, 1), (2, 2)):
        s = m.Settings(states=2, shares=shares)
        found = m.train(spark.createDataFrame(rows, "draw long, symbols binary"), v, s)
        usual = (v.totals() + 1) / (v.totals() + 1).sum()
        h, kept = m._first_model(v, s), {}
        for n in shares:
            kept = kept if len(kept) == n else {}
            for share in range(n):
                kept[share] = m.expected_counts(h, *joined([t for draw, t in enumerate(texts, -3) if draw % n == share]))
                begin, move, emit = (sum(x) for x in zip(*kept.values(), strict=True))
                begin, move, emit = 1 + begin, 0.1 + np.eye(2) + move, s.prior * usual[:, None] + emit
                h = m.Model(begin / begin.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))
        assert begin.sum() == pytest.approx(2 + len(texts))
        assert all(np.allclose(*x) for x in ((found.begin, h.begin), (found.move, h.move), (found.emit, h.emit)))
