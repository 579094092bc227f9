"""Text quality by compression.

Two zstandard dictionaries are built from good and from bad labelled text. A text is compressed with
each of them, piece by piece so that the dictionary stays what helps most; a text that resembles the
good one becomes smaller with the good dictionary. The difference of the two sizes over their sum and
the share of the text that is left with the better one, a mark of repetition, are turned into a
probability by a logistic calibration on labelled rows that no dictionary has seen.

Learning uses about ``max_rows`` labelled rows and at most ``pieces`` pieces per dictionary; scoring
compresses every whole text. Defined cases: a NULL or empty text has equal sizes and is scored like
any other; without labelled rows of both kinds every score is the share of label 1, or 0.5; repeated
rows are scored alike; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from .labelled import labelled_sample
from .shared import column_of

INPUTS = 3


@dataclass(frozen=True)
class Settings:
    max_rows: int = 20_000
    pieces: int = 1_500
    piece_chars: int = 2_000
    dictionary_bytes: int = 112 * 1024
    block_bytes: int = 4096
    level: int = 3


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    weights: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    settings: Settings


def dictionary(texts: list[str], s: Settings) -> bytes:
    """A trained dictionary, or the texts themselves where they are too few to train on."""
    samples = [t.encode() for t in texts if t]
    if sum(map(len, samples)) > 10 * s.dictionary_bytes:
        try:
            return zstandard.train_dictionary(s.dictionary_bytes, samples, k=256, d=8).as_bytes()
        except zstandard.ZstdError:
            pass
    return b"\n".join(samples)[-s.dictionary_bytes :] or b"\n" * 8


class _Sizes:
    def __init__(self, good: bytes, bad: bytes, s: Settings):
        self.block = s.block_bytes
        self.by = []
        for content in (good, bad):
            book = zstandard.ZstdCompressionDict(content)
            book.precompute_compress(level=s.level)
            self.by.append(zstandard.ZstdCompressor(level=s.level, dict_data=book, write_content_size=False, write_dict_id=False))

    def inputs(self, text: bytes) -> tuple[float, ...]:
        good = bad = 1
        view = memoryview(text)
        for at in range(0, len(text), self.block):
            piece = view[at : at + self.block]
            good += len(self.by[0].compress(piece))
            bad += len(self.by[1].compress(piece))
        left = min(good, bad) / (len(text) + 16)
        return (bad - good) / (bad + good), left, left * left


def _measure(s: Settings, shared):
    def measure(batches):
        sizes = _Sizes(*shared.value, s)
        for batch in batches:
            rows = [sizes.inputs(x.as_buffer().to_pybytes() if x.is_valid else b"") for x in column_of(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [column_of(batch, "label"), pa.array(rows, pa.list_(pa.float64()))], names=["label", "inputs"]
            )

    return measure


def _calibrated(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression with a light ridge, by Newton's steps. The last is the bias."""
    x = np.column_stack([x, np.ones(len(x))])
    w, ridge = np.zeros(x.shape[1]), np.diag([0.1] * (x.shape[1] - 1) + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, label: str, learn_from, settings: Settings | None = None) -> Model:
    s = settings or Settings()
    sample = labelled_sample(docs, labels, label, learn_from, s.max_rows)
    sample = sample.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(2)))
    length = F.greatest(F.length(F.coalesce("text", F.lit(""))) - 1, F.lit(0))
    pieces = sample.where("part = 0").select(
        "label",
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.floor(length / s.piece_chars).cast("int")),
                lambda k: F.substring(F.col("text"), k * s.piece_chars + 1, F.lit(s.piece_chars)),
            )
        ).alias("piece"),
    )
    books = []
    for kind in (1, 0):
        some = pieces.where((F.col("label") == kind) & (F.length("piece") > 0)).distinct()
        some = some.orderBy(F.xxhash64("piece"), "piece").limit(s.pieces)
        books.append(dictionary([r.piece for r in some.select("piece").collect()], s))
    shared = docs.sparkSession.sparkContext.broadcast(tuple(books))
    seen = (
        sample.where("part = 1").select("text", "label")
        .mapInArrow(_measure(s, shared), "label int, inputs array<double>").toArrow()
    )
    y = np.array(seen["label"].to_pylist(), float)
    x = np.array(seen["inputs"].to_pylist(), float).reshape(len(y), INPUTS)
    centre, scale = (x.mean(0), x.std(0)) if len(y) else (np.zeros(INPUTS), np.ones(INPUTS))
    scale = np.where(scale > 1e-12, scale, 1)
    weights = np.zeros(INPUTS + 1)
    if 0 < y.sum() < len(y):
        weights = _calibrated((x - centre) / scale, y)
    elif len(y):
        weights[-1] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    return Model(*books, weights, centre, scale, s)


def quality(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        model = shared.value
        sizes = _Sizes(model.good, model.bad, model.settings)
        for batch in batches:
            rows = [sizes.inputs(x.as_buffer().to_pybytes() if x.is_valid else b"") for x in column_of(batch, "text")]
            x = (np.array(rows, float).reshape(len(rows), INPUTS) - model.centre) / model.scale
            margin = x @ model.weights[:-1] + model.weights[-1]
            yield pa.RecordBatch.from_arrays(
                [column_of(batch, "doc_id").cast(pa.int64()), pa.array(1 / (1 + np.exp(-np.clip(margin, -30, 30))))],
                names=["doc_id", "score"],
            )

    return docs.select("doc_id", "text").mapInArrow(score, "doc_id long, score double")
