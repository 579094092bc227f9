from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tablesmith.llm import huffman_ids as h
from tablesmith.llm.shared import runs

PATH = public_tokenizers.path("word_bpe_49k.json")


def read(spark, docs, **more):
    return h.read_ids(spark, h.encoded_documents(docs, PATH, **more), h.digest, h.DIGEST).collect()


def test_round_trip_is_what_the_tokenizer_gives_for_whole_texts(spark, awkward):
    tokenizer = Tokenizer.from_file(PATH)
    expected = []
    for r in awkward.collect():
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1]
        expected.append((r.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    found = sorted(read(spark, awkward), key=lambda r: r.start)
    assert sorted((r.doc_id is not None, r.doc_id or 0, *r[2:]) for r in found) == sorted(
        (d is not None, d or 0, *rest) for d, *rest in expected
    )
    total = 0
    for r in found:
        assert r.start == total
        total += r.n_tokens
    assert [r.doc_id for r in found] == sorted((r.doc_id for r in found), key=lambda d: (d is not None, d or 0))


@pytest.mark.parametrize("part_tokens", [20_000, 90_000])
def test_parts_and_ties_keep_one_order(spark, awkward, part_tokens):
    whole = {(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in read(spark, awkward)}
    assert {tuple(r) for r in read(spark, awkward, part_tokens=part_tokens)} == whole


def test_rows_without_id_fill_parts_of_their_own(spark):
    rows = [(None if i % 3 else i, f"{i} " + "some words " * 20) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    path = h.encoded_documents(docs, PATH, part_tokens=2_000)
    blocks = spark.read.parquet(f"{path}/blocks").selectExpr("part", "explode(doc_id) AS doc_id", "n_tokens").collect()
    without, others = {r.part for r in blocks if r.doc_id is None}, {r.part for r in blocks if r.doc_id is not None}
    assert len(without) > 5 and max(without) < min(others) and max(r.n_tokens for r in blocks) < 5_000
    found = sorted(h.read_ids(spark, path, h.digest, h.DIGEST).collect(), key=lambda r: r.start)
    ids = [r.doc_id for r in found]
    assert ids == sorted((d for d, _ in rows), key=lambda d: (d is not None, d or 0))
    assert {tuple(r) for r in read(spark, docs)} == {tuple(r) for r in found}


@pytest.mark.parametrize("base", [1 << 60, -(1 << 62)])
def test_ids_beyond_doubles_stay_in_order(spark, base):
    docs = spark.createDataFrame([(base + i, f"{i * 7919 % 601} " + "some words " * 20) for i in range(600)], "doc_id long, text string")
    path = h.encoded_documents(docs, PATH, part_tokens=2_000)
    assert spark.read.parquet(f"{path}/blocks").select("part").distinct().count() > 1 or base < 0
    found = sorted(h.read_ids(spark, path, h.digest, h.DIGEST).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == [base + i for i in range(600)]


def test_pieces_are_encoded_together_and_forgotten(monkeypatch):
    monkeypatch.setattr(h, "CACHED_WORDS", 20)
    monkeypatch.setattr(h, "TOGETHER", 3)
    tokenizer, words = Tokenizer.from_file(PATH), h._WordIds(PATH)
    texts = ["", " ", "a  b\n\nc", "Don't STOP. stop, Stop!", "x\ty\u2003z", "<|endoftext|> é\u0301 ÉCOLE école.", "🙂🙂 漢字 ß.", "\x00 \u200b a"]
    texts += [" ".join(f"{w}{i}." for w in ("Alpha", "beta", "GAMMA")) for i in range(60)]
    for _ in range(2):
        for some in (texts[:9], texts[9:30], texts[30:], texts[:9]):
            expected = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, words.kind).tobytes() for t in some]
            assert words.of(some) == expected
            assert len(words.old) < 400


def test_plain_words_go_to_the_model_once(monkeypatch):
    tokenizer, words, encoded, modelled = Tokenizer.from_file(PATH), h._WordIds(PATH), [], []
    encode, of_model = words._encode, words._of_model
    monkeypatch.setattr(words, "_encode", lambda pieces: (encoded.extend(pieces), encode(pieces))[1])
    monkeypatch.setattr(words, "_of_model", lambda some: (modelled.extend(some), of_model(some))[1])
    texts = ["Straße, ÉCOLE école. Ñandú&&& STOP stop! Stop", "", None, "stop\n\nécole it's µm ½ a×b ẞ K\u0301 İ", "x²"]
    ids = words.encoded(pa.array(texts * 3), b"\x01\x00").to_pylist()
    assert ids == [np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], words.kind).tobytes() for t in texts * 3]
    assert sorted(modelled) == ["stop", "straße", "école", "ñandú"]
    assert not {"Straße,", "straße", "stop", "STOP", "école.", "&&&&"} & set(encoded) and "it's" in encoded and "ẞ" in encoded


def test_long_texts_make_runs_of_their_own():
    texts = pa.array(["ab", None, "x" * 50, "", "abc", "abcdefgh", "é"])
    assert list(runs(texts, 10)) == [(0, 2), (2, 1), (3, 2), (5, 2)]
    assert list(runs(texts.slice(2, 4), 100)) == [(0, 4)] and list(runs(texts.slice(0, 0), 10)) == []


def test_no_documents(spark, nothing):
    assert read(spark, nothing) == []


@pytest.mark.parametrize("limit", [4, 5, 16])
def test_code_lengths_are_limited_and_best(limit):
    counts = np.array([1, 1, 2, 3, 5, 8, 13, 21, 34, 55, 89, 144])
    bits = h.code_lengths(counts, limit)
    assert bits.max() <= limit and sum(2.0**-b for b in bits) == 1
    if limit == 16:
        import heapq

        heap, cost = list(counts), 0
        heapq.heapify(heap)
        while len(heap) > 1:
            both = heapq.heappop(heap) + heapq.heappop(heap)
            cost += both
            heapq.heappush(heap, both)
        assert (counts * bits).sum() == cost


def test_blocks_decode_alone():
    draw = np.random.default_rng(1)
    ids = draw.zipf(1.3, 5000) % 900
    used, n = np.unique(ids, return_counts=True)
    code = h.Code(used, h.code_lengths(n, 16))
    sizes = np.array([1, 127, 128, 129, 4615])
    data, _, checkpoints, lanes = code.encode(ids, sizes)
    starts = np.repeat(np.cumsum([0, *(-(-np.add.reduceat(code.length_of[ids], np.cumsum(sizes) - sizes) // 8))])[:-1], lanes)
    assert (h.decode(data, checkpoints + 8 * starts, sizes, code.table(), code.limit) == ids).all()
