"""Language identification with hyperdimensional profiles.

Every letter has a random vector of plus and minus ones. An n-gram's vector is the product of its
letters' vectors, each rotated by the letter's place (binding of permuted vectors); a text's profile
is the sum of the vectors of all its n-grams (bundling), and a language's prototype the sum over its
training texts. A text gets the language whose prototype has the largest cosine with its profile.

Every letter of any script has a vector of its own, drawn from a seed and its code point when it is first
met; n-gram vectors are bound on demand. Bundling is a sum, so a task adds up the profiles of its training
texts by language and sends one vector each. The sums are of whole numbers, so they don't depend on order.
Letters are folded to lower case; runs of anything else are one word boundary, which is a symbol of the
n-grams too.

Defined cases: a NULL text, or one without a letter, is ``und`` with score 0, as is everything if
nothing was learnt; ties go to the first language in alphabetical order; rows with a NULL language
teach nothing; repeated rows count each time; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import SLICE_BYTES, column_of

UNKNOWN = "und"
#: N-grams that are bound at a time, and languages a task adds up before it sends them.
BOUND, HELD_LANGUAGES = 4096, 256
_POINTS = 0x110000


@dataclass(frozen=True)
class Settings:
    dimension: int = 512
    seed: int = 7


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    prototypes: np.ndarray  # of length 1, a row per language
    settings: Settings


@cache
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.array([not 0xD800 <= p < 0xE000 and chr(p).isalpha() for p in range(_POINTS)])


class _Vectors:
    """The vectors of the letters met so far; 0 is the word boundary."""

    def __init__(self, s: Settings):
        self.settings = s
        self.row = np.full(_POINTS, -1, np.int32)
        self.rows = np.zeros((0, s.dimension), np.int8)

    def bound(self, trigrams: np.ndarray) -> np.ndarray:
        """The vectors of n-grams given as three code points each."""
        s = self.settings
        for point in np.unique(trigrams[self.row[trigrams] < 0]).tolist():
            own = np.random.default_rng([s.seed, point]).integers(0, 2, s.dimension, np.int8) * 2 - 1
            at = np.count_nonzero(self.row >= 0)
            if at == len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros((max(64, at), s.dimension), np.int8)])
            self.rows[at], self.row[point] = own, at
        first, second, third = (self.rows[self.row[trigrams[:, k]]] for k in range(3))
        return np.roll(first, 2, 1) * np.roll(second, 1, 1) * third

    def profile(self, trigrams: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The bundle of n-grams, each as often as it occurs."""
        total = np.zeros(self.settings.dimension)
        for at in range(0, len(trigrams), BOUND):
            total += counts[at : at + BOUND].astype(np.float64) @ self.bound(trigrams[at : at + BOUND])
        return total


def _runs(column: pa.Array):
    """Rows of about a slice's bytes: first row, texts."""
    sizes = [len(x.as_buffer()) if x.is_valid else 0 for x in column]
    first, total = 0, 0
    for k, size in enumerate(sizes):
        total += size
        if total >= SLICE_BYTES or k + 1 == len(sizes):
            yield first, [x or "" for x in column.slice(first, k + 1 - first).to_pylist()]
            first, total = k + 1, 0


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, n-gram) pairs by text, with their counts; an n-gram is three code points. Texts
    without letters have none."""
    lowered = ["\n" + t.lower() + "\n" for t in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), "<u4")
    points = np.where(_letters()[points], points, 0)
    text = np.repeat(np.arange(len(texts)), [len(t) for t in lowered])
    keep = np.ones(len(points), bool)
    keep[1:] = (points[1:] > 0) | (points[:-1] > 0) | (text[1:] != text[:-1])
    points, text = points[keep], text[keep]
    # Code points as their ranks among those that occur, so that three fit one number.
    seen = np.zeros(_POINTS, bool)
    seen[points] = True
    known = np.flatnonzero(seen)
    rank = np.zeros(_POINTS, np.int64)
    rank[known] = np.arange(len(known))
    ranks, size = rank[points], len(known)
    inside = text[:-2] == text[2:]
    code = ((ranks[:-2] * size + ranks[1:-1]) * size + ranks[2:])[inside]
    text = text[:-2][inside]
    order = np.lexsort((code, text)) if len(texts) * size**3 >= 1 << 63 else np.argsort(text * size**3 + code)
    code, text = code[order], text[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (text[1:] != text[:-1])
    begins = np.flatnonzero(new)
    counts = np.diff(np.append(begins, len(code)))
    code = code[begins]
    return text[begins], known[np.stack([code // size**2, code // size % size, code % size], 1)], counts


def fit(docs: DataFrame, learn_from, settings: Settings | None = None) -> Model:
    """Prototypes from ``text`` and ``lang`` of all rows that fulfil the condition ``learn_from``."""
    s = settings or Settings()

    def sums(held):
        names = list(held)
        profiles = pa.array([np.rint(held[name]).astype(np.int64).tolist() for name in names], pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), profiles], names=["lang", "profile"])

    def add_up(batches):
        vectors, held = _Vectors(s), {}
        for batch in batches:
            langs = np.array(column_of(batch, "lang").to_pylist(), object)
            for first, texts in _runs(column_of(batch, "text")):
                text, grams, n = trigrams(texts)
                theirs = langs[first : first + len(texts)]
                for lang in sorted(set(theirs)):
                    mine = (theirs == lang)[text]
                    held[lang] = held.get(lang, 0) + vectors.profile(grams[mine], n[mine])
                    if len(held) >= HELD_LANGUAGES:
                        yield sums(held)
                        held = {}
        if held:
            yield sums(held)

    rows = docs.where(learn_from & F.col("lang").isNotNull()).select("text", F.col("lang").cast("string"))
    parts = rows.mapInArrow(add_up, "lang string, profile array<long>").select("lang", F.posexplode("profile").alias("i", "v"))
    table = parts.groupBy("lang", "i").agg(F.sum("v").alias("v")).toArrow()  # languages times dimension rows
    names = sorted(set(table["lang"].to_pylist()))
    place = {name: k for k, name in enumerate(names)}
    prototypes = np.zeros((len(names), s.dimension))
    prototypes[[place[x] for x in table["lang"].to_pylist()], table["i"].to_pylist()] = table["v"].to_pylist()
    lengths = np.linalg.norm(prototypes, axis=1)
    # A language without a letter has taught nothing.
    names = [name for name, length in zip(names, lengths, strict=True) if length > 0]
    return Model(tuple(names), prototypes[lengths > 0] / lengths[lengths > 0, None], s)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score`` of every whole text; ``score`` is the cosine, 0 if negative."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compare(batches):
        model = shared.value
        vectors = _Vectors(model.settings)
        for batch in batches:
            names, scores = [], []
            for _, texts in _runs(column_of(batch, "text")):
                text, grams, n = trigrams(texts)
                cuts = np.searchsorted(text, np.arange(len(texts) + 1))
                for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                    if a == b or not len(model.languages):
                        names.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    profile = vectors.profile(grams[a:b], n[a:b])
                    cosines = model.prototypes @ profile / max(float(np.linalg.norm(profile)), 1e-9)
                    best = int(np.argmax(cosines))
                    names.append(model.languages[best])
                    scores.append(float(np.clip(cosines[best], 0, 1)))
            yield pa.RecordBatch.from_arrays(
                [column_of(batch, "doc_id").cast(pa.int64()), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"],
            )

    return docs.select("doc_id", "text").mapInArrow(compare, "doc_id long, lang_pred string, score double")
