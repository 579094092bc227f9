"""What the operators share: tables kept between jobs, held-out rows, hashed words of whole texts."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Bytes of text that are looked at together; a longer text is looked at alone.
SLICE_BYTES = 1 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``. Only a session whose executors
    are threads of the driver may lack one and gets a folder of its own."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError("Set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp()
        context._conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, path: str | None = None) -> tuple[DataFrame, str]:
    """The rows as a Parquet table in the shared folder, and its path. Cuts the lineage."""
    path = path or new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def dropped(spark: SparkSession, path: str) -> None:
    """Remove a table that ``written`` made and nobody reads any more."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id's text, modulo ``divisor``. A NULL id counts as the text ``NULL``."""
    text = F.coalesce(doc_id.cast("string"), F.lit("NULL"))
    return F.crc32(text.cast("binary")) % divisor


def text_key(text: Column) -> Column:
    """Tells rows of one ``doc_id`` apart by their texts."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


#: Ids that are broadcast; with more of them Spark shuffles both sides of the join.
BROADCAST_IDS = 1_000_000


def without(docs: DataFrame, rows: DataFrame, keep: bool = False) -> DataFrame:
    """``docs`` but those named by ``doc_id`` and ``text_key``; or only those, with ``keep``."""
    named, _ = written(rows.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).distinct(), "named")
    small = named.count() <= BROADCAST_IDS
    same = docs["doc_id"].cast("long").eqNullSafe(F.col("__id")) & (text_key(docs["text"]) == F.col("__key"))
    return docs.join(F.broadcast(named) if small else named, same, "left_semi" if keep else "left_anti")


def lowered(text: Column) -> Column:
    """A to Z in lower case, everything else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts one after another and where each begins (and the last ends).
    NULL is empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], (offsets - offsets[0]).astype(np.int64)


_kept: dict[str, dict] = {}


def give_back() -> None:
    """Return freed memory to the system. Workers live on and would hold it for whoever comes next."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def kept_by(owner: str) -> dict:
    """What an operator keeps between the tasks of one worker process. Workers are used again by other
    operators, whose tasks drop it here."""
    if others := [name for name in _kept if name != owner]:
        for other in others:
            del _kept[other]
        give_back()
    return _kept.setdefault(owner, {})


def runs(column: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """Runs of whole texts of about ``size`` bytes: first text, number of texts."""
    ends = np.cumsum(pc.binary_length(column).fill_null(0).to_numpy(), dtype=np.int64)
    first = 0
    while first < len(column):
        before = ends[first - 1] if first else 0
        last = max(int(np.searchsorted(ends, before + size, "right")), first + 1)
        yield first, last - first
        first = last


def slices(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``SLICE_BYTES``: first text, bytes, offsets."""
    kept_by("slices")
    data, offsets = text_bytes(column)
    n, first = len(offsets) - 1, 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, "right")) - 1
        last = min(max(last, first + 1), n)
        part = offsets[first : last + 1]
        yield first, data[part[0] : part[-1]], part - part[0]
        first = last


def _multiplier(seed: int) -> np.uint64:
    return np.random.default_rng(seed).integers(1 << 62, 1 << 63, dtype=np.uint64) | np.uint64(1)


_BASE = _multiplier(11)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_MIX = _multiplier(12)


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse up to ``n``."""
    powers = kept_by("slices").setdefault("powers", [np.ones(1, np.uint64)] * 2)
    if len(powers[0]) <= n:
        size = 1 << int(n).bit_length()
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            powers[k] = np.multiply.accumulate(factors)
    return powers


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


class Words:
    """64-bit hashes of the words of a run of texts, found and hashed as whole arrays.

    ``separators``: bytes between words. ``fold``: bytes counted as others, such as A as a.
    """

    def __init__(self, separators: bytes = b" \t\n\x0b\x0c\r"):
        values = np.random.default_rng(10).integers(1, 1 << 63, 256, dtype=np.uint64)
        values[65:91] = values[97:123]
        self.values = values
        self.inside = np.ones(256, bool)
        self.inside[list(separators)] = False

    def hashed(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The words' hashes in order, and where each text's words begin (and the last's end)."""
        hashes, bounds, _ = self.measured(data, offsets)
        return hashes, bounds

    def measured(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same, and the words' lengths in bytes."""
        if not len(data):
            return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), np.zeros(0, np.int64)
        inside = self.inside[data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        cuts = offsets[(offsets > 0) & (offsets < len(data))]
        begins[cuts] |= inside[cuts]
        ends[cuts - 1] |= inside[cuts - 1]
        first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        powers, inverse = _power_tables(len(data))
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * powers[: len(data)], out=total[1:])
        hashes = mixed((total[last] - total[first]) * inverse[first])
        return hashes, np.searchsorted(first, offsets), last - first


def grams(words: np.ndarray, bounds: np.ndarray, size: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of ``size`` words that lie in one text, and where each text's runs begin."""
    lengths = np.maximum(np.diff(bounds) - size + 1, 0)
    new = np.concatenate([[0], np.cumsum(lengths)])
    at = np.arange(new[-1]) + np.repeat(bounds[:-1] - new[:-1], lengths)
    total = np.zeros(len(at), np.uint64)
    for k in range(size):
        total += words[at + k] * _multiplier(seed + k)
    return mixed(total), new


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    found = batch.column(batch.schema.get_field_index(name))
    return found.combine_chunks() if isinstance(found, pa.ChunkedArray) else found


def binary_array(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())
