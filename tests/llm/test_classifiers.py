from __future__ import annotations

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablesmith.llm import compression_quality as cq, ftrl_toxicity as ft, hyperdimensional_language as hd

DATA = "/root/testdata/sf0.01"


def table(spark, name):
    return spark.read.parquet(f"{DATA}/{name}.parquet")


def test_toxicity_separates_held_out_documents(spark):
    labels = table(spark, "labels")
    model = ft.fit(table(spark, "documents"), labels, "toxic", F.col("doc_id") % 3 != 1)
    found = ft.toxicity(table(spark, "documents"), model).join(labels, "doc_id").where("doc_id % 3 = 1").toPandas()
    toxic, clean = found[found.toxic == 1].score, found[found.toxic == 0].score
    assert (clean >= 0.7).mean() < 0.02 and (toxic >= 0.7).mean() > 0.3
    assert len(model.index) < 2000


def test_quality_separates_held_out_documents(spark):
    labels = table(spark, "labels")
    model = cq.fit(table(spark, "documents"), labels, "quality", F.col("doc_id") % 5 != 0)
    found = cq.quality(table(spark, "documents"), model).join(labels, "doc_id").where("doc_id % 5 = 0").toPandas()
    assert ((found.score >= 0.3).astype(int) == found.quality).mean() > 0.85


def test_languages_of_held_out_documents(spark):
    docs = table(spark, "documents")
    model = hd.fit(docs, F.col("doc_id") % 4 != 2)
    found = hd.identify(docs, model).join(docs, "doc_id").where("doc_id % 4 = 2")
    assert found.where("lang = lang_pred").count() >= 0.99 * found.count()


def plain_profile(text, vectors):
    """Every n-gram on its own."""
    letters = re.sub("\n+", "\n", "".join(c if c.isalpha() else "\n" for c in f"\n{text.lower()}\n"))
    points = [0 if c == "\n" else ord(c) for c in letters]
    total = np.zeros(vectors.settings.dimension)
    for three in zip(points, points[1:], points[2:], strict=False):
        own = [vectors.rows[vectors.row[p]].astype(int) for p in three]
        total += np.roll(own[0], 2) * np.roll(own[1], 1) * own[2]
    return total


def test_profiles_are_sums_of_bound_vectors():
    vectors = hd._Vectors(hd.Settings(dimension=64))
    texts = ["Abca!! b", "", "Ünï \U00010400\U00010428x", "123", "漢字かな" * 30]
    text, trigrams, n = hd.trigrams(texts)
    for k, own in enumerate(texts):
        found = vectors.profile(trigrams[text == k], n[text == k])
        assert (found == plain_profile(own, vectors)).all()
    known = np.flatnonzero(vectors.row >= 0)
    assert len({tuple(vectors.rows[vectors.row[p]]) for p in known}) == len(known)


def test_languages_equal_plain_cosines(spark):
    rows = [
        (1, "le petit chat et la souris", "fr"), (2, "the small cat and the mouse", "en"), (3, "кот и мышь", "ru"),
        (4, "the end", "en"), (5, "мышь", None), (6, "la fin", None), (7, "12", "en"), (8, "and so", None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = hd.fit(docs, F.lit(True))
    vectors = hd._Vectors(model.settings)
    vectors.bound(hd.trigrams([r[1] for r in rows])[1])
    learnt = {k: sum(plain_profile(r[1], vectors) for r in rows if r[2] == k) for k in ("en", "fr", "ru")}
    for row in hd.identify(docs, model).collect():
        own = plain_profile(rows[row.doc_id - 1][1], vectors)
        cosines = {k: own @ v / (np.linalg.norm(own) * np.linalg.norm(v) or 1) for k, v in learnt.items()}
        best = max(cosines, key=cosines.get) if row.doc_id != 7 else "und"
        assert row.lang_pred == best and row.score == pytest.approx(cosines.get(best, 0), abs=1e-9)


@pytest.mark.parametrize("with_labels", [True, False])
def test_awkward_rows_are_scored(spark, awkward, labels, with_labels):
    labels = labels if with_labels else labels.where("false")
    for found in (
        ft.toxicity(awkward, ft.fit(awkward, labels, "toxic", F.lit(True))),
        cq.quality(awkward, cq.fit(awkward, labels, "quality", F.lit(True))),
        hd.identify(awkward, hd.fit(awkward if with_labels else awkward.where("false"), F.lit(True))),
    ):
        rows = found.collect()
        assert len(rows) == awkward.count() and all(0 <= r.score <= 1 for r in rows)
    by_id = {r.doc_id: r.lang_pred for r in rows}
    assert by_id[2] == by_id[3] == by_id[4] == "und"
    if with_labels:
        assert by_id[6] == "fr" and by_id[5] == "en"
    else:
        assert set(by_id.values()) == {"und"}


def test_columns_stay_when_toxic_rows_go(spark, awkward, labels, nothing):
    model = ft.fit(awkward, labels, "toxic", F.lit(True))
    kept = ft.acceptable(awkward, model)
    assert kept.columns == awkward.columns and kept.count() == awkward.count()
    assert ft.acceptable(nothing, model).collect() == [] and hd.identify(nothing, hd.fit(nothing, F.lit(True))).collect() == []
    toxic = ft.Model(-3.0, *ft_word("fox"), 24)
    assert {r.doc_id for r in ft.acceptable(awkward, toxic).collect()} == {2, 3, 4, 5, 6, 9, 10}


def ft_word(word):
    index, _ = ft.features(ft.np.frombuffer(word.encode(), ft.np.uint8), ft.np.array([0, len(word)]), 24)
    return index[:1], ft.np.array([9.0])


def test_rounds_of_toxicity_equal_a_plain_loop(spark, monkeypatch):
    monkeypatch.setattr(ft, "CHANGES", 16)
    texts = [f"w{i % 7} bad{i % 3} same words w{i % 5}, Here" if i % 4 else f"w{i % 6} fine same" for i in range(60)]
    docs = spark.createDataFrame(list(enumerate([*texts, "", None])), "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i % 4 > 0 and i % 3 == 0)) for i in range(62)], "doc_id long, toxic int")
    s = ft.Settings(rounds=3, l1=0.1)
    rows = (
        docs.join(marks, "doc_id").withColumnRenamed("toxic", "label")
        .repartitionById(2, (F.col("doc_id") % 2).cast("int")).sortWithinPartitions("doc_id").select("text", "label")
    )
    known = ft._coordinates(rows, s)
    context = spark.sparkContext
    placed = ft._places(rows, context.broadcast(known), s)
    state = np.linspace(-1, 1, len(known) + 1).astype(np.float32), np.linspace(0, 2, len(known) + 1).astype(np.float32)
    blocks = {r.block: r for r in ft._round(placed, context.broadcast(state), s).collect()}
    assert sorted(blocks) == list(range(-(-(len(known) + 1) // 16))) and len(blocks) > 2
    change = [np.concatenate([np.frombuffer(blocks[b][k]) for b in sorted(blocks)]) for k in ("dz", "dn")]
    expected = [np.zeros(len(known) + 1), np.zeros(len(known) + 1)]
    for shard in (0, 1):
        z, n = (x.astype(float) for x in state)
        for i in range(shard, 62, 2):
            data = ([*texts, "", ""][i]).encode()
            found = np.unique(ft.features(np.frombuffer(data, np.uint8), np.array([0, len(data)]), s.bits)[0])
            at = [*np.flatnonzero(np.isin(known, found)), len(known)]
            scale = (s.beta + np.sqrt(n[at])) / s.alpha + s.l2
            w = np.where(np.abs(z[at]) <= s.l1, 0, (np.sign(z[at]) * s.l1 - z[at]) / scale)
            w[-1] = -z[-1] / scale[-1]
            g = 1 / (1 + np.exp(-w.sum())) - int(i % 4 > 0 and i % 3 == 0)
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / s.alpha * w
            n[at] += g * g
        expected = [e + x - y for e, x, y in zip(expected, (z, n), state, strict=True)]
    assert np.allclose(change, expected, rtol=1e-12, atol=1e-12)
