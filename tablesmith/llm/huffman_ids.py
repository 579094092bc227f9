"""Token ids in files: length-limited canonical Huffman code in independent blocks.

The ids of all documents are counted, the counts give one code, and documents are written in
ascending ``doc_id`` order, or in the order they come in, as blocks. A file set is a folder with

* ``code``: one row per used id, ``(id, bits)``. The code is canonical: codes count up by length,
  then by id, so lengths are all a reader needs.
* ``blocks``: one row per block, ``(part, block, start, n_tokens, doc_id[], doc_tokens[],
  checkpoints[], payload)``. Each document starts on a byte. ``checkpoints`` holds the bit offset in
  ``payload`` of every 128th token of each document, so a block is decoded without any other one,
  and all its checkpoints at once. ``start`` counts tokens from the beginning of the block's part.

Defined cases: a NULL or empty text has only the end id; equal ``doc_id`` s follow each other in the
order of their coded bytes; a NULL ``doc_id`` comes first; an empty table gives an empty file set.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import codecs
import itertools
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .shared import binary_array, column_of, dropped, give_back, kept_by, new_path, runs, written

LANE = 128
BLOCK_TOKENS = 1 << 20
PART_TOKENS = 1 << 23
#: Pieces in each of two generations that a worker remembers, about 150 bytes each.
CACHED_WORDS = 1 << 18
#: Pieces that are encoded with one call.
TOGETHER = 1000
#: Bytes of text whose pieces are told apart together; a longer text is looked at alone.
TEXT_BYTES = 1 << 23
_TAIL = ".,!$%&#*?;:"
#: Below U+0100 case folding is the same everywhere and nothing composes.
_LETTERS = "".join(chr(c) for c in (*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x100)) if c not in (0xD7, 0xF7))
_PLAIN = f"^[{_LETTERS}]+[{_TAIL}]*$"


def _byte_alphabet() -> str:
    """The character that stands for each byte in byte-level vocabularies, and blanks for blanks."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    found = [chr(b if b in shown else next(others)) for b in range(256)]
    found[0x20] = " "
    return "".join(found)


_BYTES = _byte_alphabet()


def _joined(words: pa.Array) -> str:
    """All words with blanks between them."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), " ")[0].as_py()


class _WordIds:
    """Little-endian 16- or 32-bit ids of text between blanks.

    The tokenizer splits on white space before anything else, so a text's ids are the ids of what
    stands between blanks, one after another. Each different piece of a run of texts is looked up once.
    Words of plain letters go to the tokenizer's model as they are, apart from case and the punctuation
    behind them; other new pieces are encoded together. What was not seen for a whole generation is
    forgotten.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.young, self.old = {"": b""}, {}
        self.model = self.tokenizer.model
        # Whether letters reach the model as bytes, in one run, depends on the tokenizer.
        trial = ["a", "the", "unbelievably", "zq", "é", "ñandú", "straße", "çàþÿ", "ab" * 40]
        whole = [np.array(self.tokenizer.encode(w, add_special_tokens=False).ids, self.kind).tobytes() for w in trial]
        self.plain = self._of_model(trial) == whole

    def of(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        return self.encoded(pa.array(texts, pa.string())).to_pylist()

    def encoded(self, texts: pa.Array, end: bytes = b"") -> pa.Array:
        """The ids of each text and ``end``."""
        split = pc.split_pattern(pc.replace_substring(texts.fill_null(""), "\n", " "), " ")
        pieces = split.flatten().dictionary_encode()
        ids = pa.concat_arrays([self._ids(pieces.dictionary), pa.array([end], pa.binary())])
        counts = pc.list_value_length(split).to_numpy()
        last = np.cumsum(counts, dtype=np.int64)
        # Each text's pieces and the end, put one after another; texts are cut out of the whole again.
        placed = np.insert(pieces.indices.to_numpy(), last, len(ids) - 1)
        _, offsets, data = ids.take(pa.array(placed)).buffers()
        offsets = np.frombuffer(offsets, np.int32)[np.concatenate([[0], last + np.arange(1, len(last) + 1)])]
        if len(self.young) > CACHED_WORDS:
            self.old, self.young = {k: v for k, v in self.young.items() if len(k) <= 64}, {"": b""}
        return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(offsets), data])

    def _ids(self, pieces: pa.Array) -> pa.Array:
        """The ids of each of some different pieces."""
        plain = pc.match_substring_regex(pieces, _PLAIN) if self.plain else pa.array([False] * len(pieces), pa.bool_())
        some = pieces.filter(plain)
        words = pc.utf8_lower(pc.utf8_rtrim(some, characters=_TAIL)).dictionary_encode()
        tails = pc.utf8_ltrim(some, characters=_LETTERS).dictionary_encode()
        others = pieces.filter(pc.invert(plain)).to_pylist()
        found = _joined(words.dictionary).split(" ") if len(some) else []
        new = list(self._remembered([word for word in found if word not in self.young]))
        if new:
            self.young.update(zip(new, self._of_model(new), strict=True))
        self._learn({*others, *tails.dictionary.to_pylist()}.difference(self.young))
        known = self.young.__getitem__
        words, tails = (
            pa.array([*map(known, keys)], pa.binary()).take(x.indices)
            for keys, x in ((found, words), (tails.dictionary.to_pylist(), tails))
        )
        ids = pa.concat_arrays([pc.binary_join_element_wise(words, tails, b""), pa.array([*map(known, others)], pa.binary())])
        first = plain.to_numpy(zero_copy_only=False)
        return ids.take(pa.array(np.where(first, np.cumsum(first) - 1, len(some) + np.cumsum(~first) - 1)))

    def _of_model(self, words) -> list[bytes]:
        """The ids of words of lower-case letters, each a run of its own for the tokenizer."""
        shown = codecs.charmap_decode(" ".join(words).encode(), "strict", _BYTES)[0].split(" ")
        tokenize, ids, ends = self.model.tokenize, array(self.kind.char), [0]
        for word in shown:
            ids.extend([token.id for token in tokenize(word)])
            ends.append(len(ids))
        found, size = np.array(ids, self.kind).tobytes(), self.kind.itemsize
        return [found[a * size : b * size] for a, b in itertools.pairwise(ends)]

    def _remembered(self, pieces: Iterable[str]) -> set[str]:
        """Those that no generation knows; the others are young again."""
        unknown = set()
        for piece in pieces:
            if piece in self.old:
                self.young[piece] = self.old[piece]
            else:
                unknown.add(piece)
        return unknown

    def _learn(self, pieces: set[str]) -> None:
        whole, made = set(), []
        for piece in self._remembered(pieces):
            # Below U+0100 case folding is the same everywhere and nothing composes; punctuation after a
            # letter is always a token run of its own.
            if (piece.isascii() or max(piece) < "Ā") and "<|" not in piece:
                plain = piece.lower()
                core = plain.rstrip(_TAIL)
                if core and core != piece and (core == plain or core[-1].isalpha()):
                    made.append((piece, core, plain[len(core) :]))
                    continue
            whole.add(piece)
        parts = {x for _, core, tail in made for x in (core, tail)}.difference(self.young)
        self._encode(list(whole | self._remembered(parts)))
        for piece, core, tail in made:
            self.young[piece] = self.young[core] + self.young[tail]

    def _encode(self, pieces: list[str]) -> None:
        """Encode pieces with blanks between them, and cut where each begins."""
        for first in range(0, len(pieces), TOGETHER):
            some = pieces[first : first + TOGETHER]
            found = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            ids = np.array(found.ids, self.kind).tobytes()
            begins = np.fromiter((begin for begin, _ in found.offsets), np.int64, len(found.ids))
            lengths = np.fromiter(map(len, some), np.int64, len(some)) + 1
            cuts = [*(np.searchsorted(begins, np.cumsum(lengths) - lengths) * self.kind.itemsize).tolist(), len(ids)]
            self.young.update((piece, ids[cuts[i] : cuts[i + 1]]) for i, piece in enumerate(some))


def _encoder(path: str) -> _WordIds:
    encoders = kept_by("token ids")
    if path not in encoders:
        encoders[path] = _WordIds(path)
    return encoders[path]


def _place(docs: DataFrame) -> Column:
    """A number that rises with the rows: in a table that Spark wrote by the number of the file and the row
    in it, else by partition."""
    try:
        at = docs.metadataColumn("_metadata")
        name, row = at["file_name"], at["row_index"]
        docs.select(row)
    except AnalysisException:
        return F.monotonically_increasing_id()
    # part-<task>-...-c<file of the task>; files of other names come first.
    task, file = (F.regexp_extract(name, x, 1).try_cast("long") for x in (r"^part-(\d+)", r"-c(\d+)\."))
    task, file = F.coalesce(task, F.lit(0)), F.coalesce(file, F.lit(0))
    return F.shiftleft(task, 41) + F.shiftleft(F.least(file, F.lit(1023)), 31) + row


def token_ids(docs: DataFrame, tokenizer: str, end_id: int, id_col="doc_id", text_col="text", in_order=False) -> DataFrame:
    """``doc_id``, ``n_tokens`` and ``ids`` (little-endian) of every whole text, with the end id; and the row's
    ``place`` among all rows, if asked for."""
    more = ["place"] if in_order else []

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _encoder(tokenizer)
        end = np.array([end_id], words.kind).tobytes()
        for batch in batches:
            texts = column_of(batch, "text")
            for first, n in runs(texts, TEXT_BYTES):
                ids = words.encoded(texts.slice(first, n), end)
                sizes = pc.divide(pc.binary_length(ids).cast(pa.int64()), words.kind.itemsize)
                yield pa.RecordBatch.from_arrays(
                    [column_of(batch, "doc_id").slice(first, n), sizes, ids, *[column_of(batch, c).slice(first, n) for c in more]],
                    names=["doc_id", "n_tokens", "ids", *more],
                )
        give_back()

    place = [_place(docs).alias("place")] if in_order else []
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *place)
    return source.mapInArrow(encode, "doc_id long, n_tokens long, ids binary" + (", place long" if in_order else ""))


def id_counts(ids: DataFrame, kind: str) -> DataFrame:
    """How often each id occurs: counted per task, summed by id."""

    def count(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            for row in column_of(batch, "ids"):
                found = np.bincount(np.frombuffer(row.as_buffer(), kind))
                if len(found) > len(total):
                    total, found = found.astype(np.int64), total
                total[: len(found)] += found
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])

    return ids.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Bits per symbol of the best prefix code without a code longer than ``limit`` (package-merge)."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    if n > 1 << limit:
        raise ValueError(f"{n} symbols need codes longer than {limit} bits")
    order = np.argsort(counts, kind="stable")
    weights = counts[order].astype(np.int64)
    current, levels = weights, [np.ones(n, bool)]
    for _ in range(limit - 1):
        pairs = current[: len(current) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([weights, pairs])
        rank = np.argsort(both, kind="stable")
        current = both[rank]
        levels.append(rank < n)
    bits, take = np.zeros(n, np.int64), 2 * n - 2
    for leaf in reversed(levels):
        leaves = int(leaf[:take].sum())
        bits[:leaves] += 1
        take = 2 * (take - leaves)
    lengths = np.zeros(n, np.int64)
    lengths[order] = bits
    return lengths


class Code:
    """A canonical code: ids with their lengths in bits."""

    def __init__(self, ids: np.ndarray, bits: np.ndarray):
        order = np.lexsort((ids, bits))
        self.ids, self.bits = ids[order].astype(np.int64), bits[order].astype(np.int64)
        self.limit = int(self.bits[-1]) if len(bits) else 1
        steps = np.left_shift(1, self.limit - self.bits)
        aligned = np.cumsum(steps) - steps
        size = int(self.ids.max()) + 1 if len(ids) else 1
        self.length_of, self.code_of = np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.length_of[self.ids] = self.bits
        self.code_of[self.ids] = aligned >> (self.limit - self.bits)
        self.steps = steps

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """Id and length for every possible run of ``limit`` bits."""
        ids, bits = np.repeat(self.ids, self.steps), np.repeat(self.bits, self.steps)
        missing = (1 << self.limit) - len(ids)
        return np.pad(ids, (0, missing)), np.pad(bits, (0, missing), constant_values=1)

    def encode(self, ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bytes of documents one after another, each on a byte boundary, bytes per document, bit
        offsets of the checkpoints within each document, checkpoints per document."""
        bits = self.length_of[ids]
        before = np.cumsum(bits) - bits
        first = np.cumsum(sizes) - sizes
        doc_bits = np.add.reduceat(bits, first)
        doc_bytes = (doc_bits + 7) // 8
        starts = np.cumsum(doc_bytes) - doc_bytes
        local = before - np.repeat(before[first], sizes)
        at = local + np.repeat(starts * 8, sizes)
        word = self.code_of[ids] << (32 - bits - (at & 7))
        out = np.zeros(int(doc_bytes.sum()) + 4)
        for k in range(4):
            out += np.bincount((at >> 3) + k, (word >> (24 - 8 * k)) & 255, len(out))
        lanes = (sizes + LANE - 1) // LANE
        inner = np.arange(int(lanes.sum())) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        checkpoints = local[np.repeat(first, lanes) + inner * LANE]
        return out[:-4].astype(np.uint8), doc_bytes, checkpoints, lanes


def decode(payload: np.ndarray, checkpoints: np.ndarray, sizes: np.ndarray, table, limit: int) -> np.ndarray:
    """All ids of a block. Every checkpoint's lane moves on by one table look-up per step."""
    ids_of, bits_of = table
    lanes = (sizes + LANE - 1) // LANE
    inner = np.arange(int(lanes.sum())) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    length = np.minimum(np.repeat(sizes, lanes) - inner * LANE, LANE)
    target = np.cumsum(length) - length
    order = np.argsort(-length, kind="stable")
    position, target, length = checkpoints[order].astype(np.int64), target[order], length[order]
    padded = np.concatenate([payload, np.zeros(4, np.uint8)]).astype(np.int64)
    window = padded[:-3] << 24 | padded[1:-2] << 16 | padded[2:-1] << 8 | padded[3:]
    out = np.zeros(int(sizes.sum()), np.int64)
    active = np.searchsorted(-length, -np.arange(LANE), "left")
    for step in range(int(length[0]) if len(length) else 0):
        n = active[step]
        position, target = position[:n], target[:n]
        found = (window[position >> 3] >> (32 - limit - (position & 7))) & ((1 << limit) - 1)
        out[target + step] = ids_of[found]
        position = position + bits_of[found]
    return out


_BLOCKS = (
    "part int, block int, start long, n_tokens long, doc_id array<long>, doc_tokens array<long>, "
    "checkpoints array<long>, payload binary"
)


def write_ids(ids: DataFrame, path: str, kind: str, part_tokens: int = PART_TOKENS) -> None:
    """Write what ``token_ids`` returned, which should be a stored table as it is read three times; by
    ``place`` if it has that."""
    spark, key = ids.sparkSession, "place" if "place" in ids.columns else "doc_id"
    counts = id_counts(ids, kind).toArrow()  # a row per id of the vocabulary at most
    used, n = counts["id"].to_numpy(), counts["n"].to_numpy()
    limit = max(16, int(len(used)).bit_length() + 1)
    by_id = np.argsort(used)
    code = Code(used[by_id], code_lengths(n[by_id], limit))
    spark.createDataFrame(
        list(zip(code.ids.tolist(), code.bits.tolist(), strict=True)), "id long, bits long"
    ).coalesce(1).write.parquet(f"{path}/code")
    # Rows without doc_id come first, in parts of their own.
    unknown = ids.where(F.col(key).isNull()).agg(F.sum("n_tokens")).first()[0] or 0
    leading = -(-unknown // part_tokens)
    parts = max(1, -(-(int(n.sum()) - unknown) // part_tokens))
    cuts = [k / parts for k in range(1, parts)]
    # Bounds need not be ids: as longs they split ids beyond 2^53 in order, too.
    found = ids.approxQuantile(key, cuts, 0.2 / parts) if cuts else []
    bounds = np.array([min(int(x), (1 << 63) - 1) for x in found], np.int64)
    shared = spark.sparkContext.broadcast((code, bounds, leading))  # a vocabulary and a number per part

    def encode(batches):
        code, bounds, leading = shared.value
        for batch in batches:
            column = column_of(batch, "ids")
            for first in range(0, len(column), 500):
                raw = [x.as_py() for x in column.slice(first, 500)]
                sizes = np.array([len(x) for x in raw], np.int64) // np.dtype(kind).itemsize
                data, n_bytes, checkpoints, lanes = code.encode(np.frombuffer(b"".join(raw), kind), sizes)
                doc, own = (column_of(batch, c).slice(first, 500) for c in ("doc_id", key))
                at = np.array(own.fill_null(-(1 << 63)), np.int64)
                low, high = np.searchsorted(bounds, at, "left"), np.searchsorted(bounds, at, "right")
                data, ends = data.tobytes(), np.cumsum(n_bytes)
                bits = [data[e - s : e] for s, e in zip(n_bytes, ends, strict=True)]
                share = np.array([zlib.crc32(x) for x in bits], np.int64)
                # Rows of one id are dealt over all parts that it fills.
                part = leading + low + (share * (high - low + 1) >> 32)
                part = np.where(np.array(own.is_null()), share * leading >> 32, part)
                edges = pa.array(np.concatenate([[0], np.cumsum(lanes)]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part, pa.int32()), own, doc, pa.array(share), pa.array(sizes),
                     pa.ListArray.from_arrays(edges, pa.array(checkpoints, pa.int64())), binary_array(bits)],
                    names=["part", "own", "doc_id", "share", "n_tokens", "checkpoints", "bits"],
                )

    def block(part, number, start, rows):
        sizes = np.array([r[1] for r in rows], np.int64)
        offsets = np.cumsum([0] + [len(r[3]) for r in rows])[:-1]
        checkpoints = np.concatenate([r[2] + 8 * o for r, o in zip(rows, offsets, strict=True)])
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([start], pa.int64()),
             pa.array([int(sizes.sum())], pa.int64()), pa.array([[r[0] for r in rows]], pa.list_(pa.int64())),
             pa.array([sizes], pa.list_(pa.int64())), pa.array([checkpoints], pa.list_(pa.int64())),
             binary_array([b"".join(r[3] for r in rows)])],
            names=["part", "block", "start", "n_tokens", "doc_id", "doc_tokens", "checkpoints", "payload"],
        )

    def assemble(batches):
        part, number, start, rows, tokens = None, 0, 0, [], 0
        for batch in batches:
            columns = [column_of(batch, c) for c in ("part", "doc_id", "n_tokens", "checkpoints", "bits")]
            for k in range(len(batch)):
                p, doc, n, checkpoints, bits = (c[k] for c in columns)
                if rows and (p.as_py() != part or tokens >= BLOCK_TOKENS):
                    yield block(part, number, start, rows)
                    number, start, rows, tokens = number + 1, start + tokens, [], 0
                if p.as_py() != part:
                    part, number, start = p.as_py(), 0, 0
                checkpoints = np.array(checkpoints.values, np.int64)
                rows.append((doc.as_py(), n.as_py(), checkpoints, bits.as_py()))
                tokens += n.as_py()
        if rows:
            yield block(part, number, start, rows)

    (
        ids.mapInArrow(
            encode, "part int, own long, doc_id long, share long, n_tokens long, checkpoints array<long>, bits binary"
        )
        .repartitionById(leading + parts, "part")
        .sortWithinPartitions("part", F.asc_nulls_first("own"), "share", "bits")
        .mapInArrow(assemble, _BLOCKS)
        .write.option("compression", "zstd")
        .parquet(f"{path}/blocks")
    )
    shared.destroy()


def read_ids(spark: SparkSession, path: str, of_document: Callable, schema: str) -> DataFrame:
    """Decode a file set. ``of_document(doc_id, start, ids)`` gives the tuple of one document's row,
    ``schema`` names its columns; ``start`` counts the ids of all documents before it."""
    used = spark.read.schema("id long, bits long").parquet(f"{path}/code").toArrow()
    code = Code(used["id"].to_numpy(), used["bits"].to_numpy())
    shared = spark.sparkContext.broadcast(code)
    blocks = spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")
    # One row per part, of which there is one for every PART_TOKENS tokens.
    sums = blocks.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    before = sums.select(
        "part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("before")
    )
    placed = blocks.join(F.broadcast(before), "part").withColumn("start", F.col("before") + F.col("start"))
    arrow = to_arrow_schema(spark.createDataFrame([], schema).schema)

    def read(batches):
        code = shared.value
        table = code.table()
        for batch in batches:
            columns = [
                column_of(batch, c) for c in ("start", "doc_id", "doc_tokens", "checkpoints", "payload")
            ]
            for k in range(len(batch)):
                start, docs, sizes, checkpoints, payload = (c[k] for c in columns)
                sizes = np.array(sizes.values, np.int64)
                ids = decode(
                    np.frombuffer(payload.as_buffer(), np.uint8),
                    np.array(checkpoints.values, np.int64), sizes, table, code.limit,
                )
                ends = np.cumsum(sizes)
                rows = [
                    of_document(d, start.as_py() + int(e - s), ids[e - s : e])
                    for d, s, e in zip(docs.as_py(), sizes, ends, strict=True)
                ]
                arrays = [pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), arrow, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return placed.select("start", "doc_id", "doc_tokens", "checkpoints", "payload").mapInArrow(read, schema)


def digest(doc_id, start, ids):
    return doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())


DIGEST = "doc_id long, start long, n_tokens long, ids_crc32 long"


def encoded_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, path: str | None = None,
                      part_tokens: int = PART_TOKENS, in_order: bool = False) -> str:
    """Write the file set of ``docs`` and return its folder: by ``doc_id``, or ``in_order`` of the rows."""
    spark = docs.sparkSession
    kept, at = written(token_ids(docs, tokenizer, end_id, in_order=in_order), "token-ids")
    path = path or new_path(spark, "huffman")
    write_ids(kept, path, _encoder(tokenizer).kind.str, part_tokens)
    dropped(spark, at)
    return path
