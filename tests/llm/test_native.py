"""Contamination, personal data, mixing and search against plain Python."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from tablesmith.llm import hamming_search as hs, personal_data as pd_, temperature_mixing as tm, winnowing as w

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))


def brute_contamination(text, items):
    found, hit, named = words(text), set(), set()
    for item, content in items:
        theirs = words(content)
        size = min(10, len(theirs))
        for at in range(len(theirs) - size + 1) if size else ():
            for k in range(len(found) - size + 1):
                if found[k : k + size] == theirs[at : at + size]:
                    hit.update(range(k, k + size))
                    if item is not None:
                        named.add(str(item))
    return len(found), len(hit), sorted(named)


def test_contamination_equals_brute_force(spark, awkward):
    draw = random.Random(3)
    word = lambda: draw.choice("abcdefgh")
    items = [(i, " ".join(word() for _ in range(draw.choice([0, 1, 3, 9, 10, 11, 30])))) for i in range(12)]
    items += [(50, items[3][1]), (None, items[4][1]), (51, None), (52, "fox jumps over"), (53, "lazy, dog")]
    texts = [" ".join(word() for _ in range(draw.randint(0, 120))) for _ in range(40)]
    texts += [f"x y {items[k][1].upper()}, z {items[k][1]}" for k in range(12)] + ["a " * 300]
    rows = [(i, t) for i, t in enumerate(texts)]
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("row", F.lit(1))
    docs = spark.createDataFrame(rows, "doc_id long, text string").union(awkward.select(F.col("doc_id") + 1000, "text"))
    found = w.contamination(docs, benchmark).collect()
    expected = [(r.doc_id, *brute_contamination(r.text, items)) for r in docs.collect()]
    assert sorted(map(repr, ((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found))) == sorted(map(repr, expected))


def test_clean_documents_stay(spark, awkward, nothing):
    benchmark = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog")], "item_id long, text string")
    kept = w.clean_documents(awkward, benchmark)
    assert kept.columns == awkward.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 5, 6, 9, 10]
    assert w.clean_documents(awkward, benchmark.where("false")).count() == awkward.count()
    assert w.clean_documents(nothing, benchmark).collect() == []


CASES = [
    ("mail a.b@c.de, x@y", "email:5:13"),
    ("a@b.c_d@e.f", "email:0:5,email:5:11"),
    ("1.2.3.4.5.6.7.8 300.1.1.1", "ip:0:7,ip:8:15"),
    ("ü 001.02.255.0000256 🙂 9.9.9.9", "ip:23:30"),
    ("4111 1111-1111 1111 and 4111111111111112", "card:0:19"),
    ("+1 (136) 555-7479. +1 2", "phone:0:17"),
    ("IBAN GB82 WEST 1234 5698 7654 32.", "iban:5:32"),
    ("IBAN GB83 WEST 1234 5698 7654 32 xGB82WEST12345698765432", ""),
    ("SSN 123-45-6789 and far from any such word, where nothing is said of it, 123-45-6780", "ssn:4:15"),
    ("ssn 0123-45-6789 ssn 123-45-67890", ""),
    ("🙂" * 1020 + " IBAN GB82WEST12345698765432 " + "é" * 2000 + " social 123-45-6789", "iban:1026:1048,ssn:3057:3068"),
    ("1" * 30_000 + " " + "a" * 5000, ""),
    ("", ""),
    (None, ""),
]


def test_spans(spark, awkward, nothing):
    docs = spark.createDataFrame([(t, s, 1) for t, s in CASES], "text string, expected string, spans_ int")
    found = pd_.personal_data(docs).select("expected", pd_.as_text(F.col("spans")).alias("s")).collect()
    assert [r.s for r in found] == [r.expected for r in found]
    assert pd_.personal_data(awkward).count() == awkward.count() and pd_.personal_data(nothing).collect() == []


def test_context_raises_a_score(spark):
    docs = spark.createDataFrame([("visa 4111111111111111",), ("xxxx 4111111111111111",)], "text string")
    first, second = (r.spans[0].score for r in pd_.personal_data(docs).collect())
    assert first == pytest.approx(0.8) and second == pytest.approx(0.6)


def test_many_matches_of_one_text(spark):
    """Places are counted over blocks; the work grows with the matches."""
    texts = ["12 345 " * n for n in (1, 127, 128, 129, 20_000)] + ["ab@c.de, " * n for n in (255, 256, 257, 8_000)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    for row in pd_.personal_data(docs).collect():
        expected = [m.span() for m in re.finditer(r"[a-z]+@[a-z]+\.[a-z]+", row.text)]
        assert [(s.start, s.end) for s in row.spans if s.kind == 0] == expected


def test_new_columns_take_the_place_of_old_ones(spark):
    docs = spark.createDataFrame([(1, "a@b.c", "s", 1, 2, 3, 4, 5, 6)], [
        "doc_id", "text", "source", "spans", "mix_cell", "mix_epoch", "mix_turn", "mix_source", "mix_of"])
    found = pd_.personal_data(docs)
    assert sorted(found.columns) == sorted(docs.columns) and len(found.first().spans) == 1
    mixed = tm.mixed_documents(docs)
    row = mixed.first()
    assert mixed.columns == ["doc_id", "text", "source", "spans", "mix_source", "mix_of", "mix_cell", "mix_epoch", "mix_turn"]
    assert (row.mix_source, row.mix_of, row.mix_epoch, row.mix_turn) == (5, 6, 0, 0.5)


def test_mixture_meets_its_limits(spark):
    rows = [(i, "t " * 10, "big" if i < 700 else f"small{i % 3}") for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = tm.mixed_documents(docs).groupBy("source", "doc_id").count().groupBy("source").agg(
        F.count("*").alias("docs"), F.sum("count").alias("rows"))
    found = {r.source: (r.docs, r["rows"]) for r in mixed.collect()}
    assert found["big"] == (700, 700)
    for name in ("small0", "small1", "small2"):
        assert found[name][0] == 100 and 190 <= found[name][1] <= 200
    half = tm.mixed_documents(docs, tm.Settings(budget=5_000)).groupBy("source").count().collect()
    assert abs(10 * sum(r["count"] for r in half) - 5_000) < 400


def test_turns_keep_the_weights(spark):
    rows = [(i, "t " * 10, "a" if i < 2000 else "b") for i in range(3000)]
    mixed = tm.mixed_documents(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    early = mixed.where("mix_turn < 0.25").groupBy("source").count().collect()
    whole = mixed.groupBy("source").count().collect()
    share = lambda rows: {r.source: r["count"] / sum(x["count"] for x in rows) for r in rows}
    assert share(early)["a"] == pytest.approx(share(whole)["a"], abs=0.02)


def test_mixing_awkward_rows(spark, awkward, nothing):
    mixed = tm.mixed_documents(awkward)
    assert set(awkward.columns) < set(mixed.columns)
    assert {r.doc_id for r in mixed.collect()} == {r.doc_id for r in awkward.collect()}
    assert tm.mixed_documents(nothing).collect() == []
    assert tm.mixed_documents(awkward.where("doc_id in (2, 3, 4)")).count() == 3


@pytest.mark.parametrize("n, k, hot", [(300, 5, 0), (300, 5, 150), (1, 3, 0), (2, 3, 0), (40, 60, 10)])
def test_neighbours_equal_brute_force(spark, n, k, hot):
    draw = random.Random(n + hot)
    codes = [draw.getrandbits(64) if draw.random() < 0.5 else draw.getrandbits(12) for _ in range(n)]
    codes[:hot] = [7] * hot
    rows = [(i, c - (1 << 64) if c >> 63 else c) for i, c in enumerate(codes)]
    df = spark.createDataFrame([*rows, (None, 1), (9999, None)], "id long, code long")
    found = hs.nearest(df, df.where("id % 10 = 0 OR id = 9999"), k).collect()
    expected = []
    for q in range(0, n, 10):
        near = sorted((bin(codes[q] ^ c).count("1"), i) for i, c in enumerate(codes) if i != q)[:k]
        expected += [(q, rank, i, d) for rank, (d, i) in enumerate(near, 1)]
    assert sorted(tuple(r) for r in found) == sorted(expected)


def test_sign_codes(spark):
    vectors = [([1.0, -1.0, 0.0, 2.0],), ([],), (None,), ([float(i % 2) for i in range(64)],), ([None, 1.0],)]
    df = spark.createDataFrame(vectors, "v array<float>")
    odd = sum(1 << i for i in range(1, 64, 2)) - (1 << 64)
    assert [r[0] for r in df.select(hs.sign_code(F.col("v"))).collect()] == [9, None, None, odd, 2]
    with pytest.raises(Exception, match="longer"):
        spark.createDataFrame([([1.0] * 65,)], "v array<float>").select(hs.sign_code(F.col("v"))).collect()


def test_no_neighbours_in_an_empty_table(spark):
    df = spark.createDataFrame([], "id long, code long")
    assert hs.nearest(df, df, 3).collect() == []


def test_repeated_rows_take_no_neighbours_place(spark):
    rows = [(1, 7)] * 5 + [(2, 7), (3, 7), (4, 255)]
    df = spark.createDataFrame(rows, "id long, code long")
    query = spark.createDataFrame([(9, 7)], "id long, code long")
    found = sorted(hs.nearest(df, query, 2).collect(), key=lambda r: r["rank"])
    assert [(r.id, r.distance) for r in found] == [(1, 0), (2, 0)]
