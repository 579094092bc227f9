"""Near duplicates by a size-aware similarity join of shingle sets, and their components.

A document's set holds the 64-bit hashes of its distinct runs of ``width`` words; with fewer words
the whole text is one run. Documents with equal sets form one class, and classes are joined:

* All sets are put in one order, rare shingles first. Two sets that are similar enough share one of
  their first ``n - t*n + 1`` elements, and two of their first ``n - t*n + 2``.
* *Light* sets, up to a boundary size, are joined by the subsets of two elements of that prefix:
  enumerated, they meet only where both elements agree. *Heavy* sets, and the light ones near the
  boundary, are joined by inverted lists of single elements. The boundary is the size up to which
  enumerating costs less than scanning lists: entries to move and comparisons to expect, from the
  sizes and list lengths in the table.
* A key's members are not paired with each other. First each is compared with one member, the one
  that has least before the key. Verified links give components, and only members of a key that are
  in different components after that are compared with each other, so no link between components is
  lost while copies of one text cost one comparison each.
* A comparison is first made on sizes and positions, then on the two whole sets.

The order of shingles only steers cost, never results, so frequent shingles are found on a fixed
share of the documents. Lists of any length are joined by shuffled joins that Spark can split.

Defined cases: a NULL, empty or wordless text has an empty set, links with nothing and is its own
component; repeated rows are copies; a NULL ``doc_id`` counts as larger than any other; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .components import components
from .shared import Words, binary_array, column_of, dropped, grams, mixed, slices, text_key, without, written

_WORDS = Words()
#: Nodes whose texts are fetched by a broadcast; with more of them Spark shuffles both sides.
BROADCAST_IDS = 1_000_000


@dataclass(frozen=True)
class Settings:
    width: int = 4
    percent: int = 85  # 100 * intersection >= percent * union
    share: int = 32  # one document in so many shows which shingles are frequent
    frequent: int = 1 << 18  # frequent shingles that are told apart by their counts


def _sets(data, offsets, width):
    """The distinct shingles of each text of a run, sorted, with the signed node id of the set."""
    words, bounds = _WORDS.hashed(data, offsets)
    runs, run_bounds = grams(words, bounds, width, 300)
    for k in range(len(offsets) - 1):
        found = runs[run_bounds[k] : run_bounds[k + 1]]
        n = bounds[k + 1] - bounds[k]
        if 0 < n < width:
            found, _ = grams(words[bounds[k] : bounds[k + 1]], np.array([0, n]), int(n), 400 + 10 * int(n))
        found = np.sort(found)
        if len(found) > 1:
            found = found[np.concatenate([[True], found[1:] != found[:-1]])]
        yield k, found


def _node(found: np.ndarray) -> int:
    total = mixed(found).sum() + np.uint64(len(found))
    return int(mixed(np.array([total]))[0].astype(np.int64))


def shingle_sets(docs: DataFrame, s: Settings) -> DataFrame:
    """``text`` replaced by ``n_shingles`` and ``node``, which is equal for equal sets."""

    rest = docs.drop("text").schema

    def describe(batches):
        for batch in batches:
            sizes, nodes = [], []
            for _, data, offsets in slices(column_of(batch, "text")):
                for _, found in _sets(data, offsets, s.width):
                    sizes.append(len(found))
                    nodes.append(_node(found))
            yield pa.RecordBatch.from_arrays(
                [*[column_of(batch, n) for n in rest.names], pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64())],
                names=[*rest.names, "n_shingles", "node"],
            )

    fields = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in rest.fields)
    return docs.mapInArrow(describe, f"{fields}n_shingles long, node long")


def _frequent(docs: DataFrame, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles of one document in ``share``, and their counts there."""

    def every(batches):
        for batch in batches:
            for _, data, offsets in slices(column_of(batch, "text")):
                found = [x for _, x in _sets(data, offsets, s.width)]
                values = np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(values)], names=["key"])

    part = docs.where(F.pmod(F.xxhash64("text"), F.lit(s.share)) == 0)
    counts, path = written(
        part.mapInArrow(every, "key long").groupBy("key").agg(F.count("*").alias("n")).where("n > 2"), "counts"
    )
    # How many shingles have each count: the counts differ little, so this is short.
    steps = sorted(counts.groupBy("n").count().collect(), key=lambda r: -r[0])
    total, least = 0, None
    for n, many in steps:
        total += many
        if total > s.frequent:
            break
        least = n
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    table = counts.where(F.col("n") >= least).toArrow()  # `frequent` rows at most
    dropped(docs.sparkSession, path)
    keys, n = table["key"].to_numpy().view(np.uint64), table["n"].to_numpy()
    order = np.argsort(keys)
    return keys[order], n[order]


class _Order:
    """Rare first: shingles that aren't among the frequent ones by hash, then those by count."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, share: int):
        self.keys, self.counts, self.share = keys, counts, share
        self.seen = np.zeros(1 << 22, bool)
        self.seen[(keys >> np.uint64(42)).astype(np.int64)] = True

    def ordered(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The set in order, and an estimate of each element's list length."""
        length = np.ones(len(found), np.int64)
        maybe = np.flatnonzero(self.seen[(found >> np.uint64(42)).astype(np.int64)])
        if len(maybe):
            at = np.minimum(np.searchsorted(self.keys, found[maybe]), len(self.keys) - 1)
            hit = self.keys[at] == found[maybe]
            length[maybe[hit]] = self.counts[at[hit]] * self.share
            order = np.argsort(length, kind="stable")
            return found[order], length[order]
        return found, length


def _need(n: int, s: Settings) -> int:
    return -(-s.percent * n // 100)


def _boundary(docs: DataFrame, order, s: Settings) -> int:
    """The size up to which enumerating subsets is cheaper than scanning lists."""

    def costs(batches):
        rows = {}
        for batch in batches:
            for _, data, offsets in slices(column_of(batch, "text")):
                for _, found in _sets(data, offsets, s.width):
                    n = len(found)
                    if n < 2:
                        continue
                    p = n - _need(n, s) + 1
                    _, length = order.value.ordered(found)
                    # Each entry is moved; a list's entry is compared once if it isn't alone, a
                    # subset's only if both elements are frequent.
                    often = length[: p + 1] > 1
                    pairs, both = min(p + 1, n) * min(p, n - 1) // 2, int(often.sum())
                    a, b = rows.get(n, (0, 0))
                    rows[n] = a + pairs + both * (both - 1) // 2, b + p + int(often[:p].sum())
        sizes = list(rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(sizes, pa.int64()), pa.array([rows[n][0] for n in sizes], pa.int64()),
             pa.array([rows[n][1] for n in sizes], pa.int64())], names=["n", "subsets", "lists"],
        )

    part = docs.where(F.pmod(F.xxhash64("text"), F.lit(s.share)) == 1)
    # Sizes above 2**12 can't be light: their subsets alone would outnumber any list's share.
    found = (
        part.mapInArrow(costs, "n long, subsets long, lists long")
        .where("n < 4096").groupBy("n").agg(F.sum("subsets").alias("x"), F.sum("lists").alias("y"))
    )
    best, least, total = 1, 0, 0
    for n, x, y in sorted(found.collect()):
        total += x - y
        if total < least:
            best, least = n, total
    return best


def _postings(docs: DataFrame, order, light: int, s: Settings) -> DataFrame:
    """``key, node, place``: subset and list keys of every set. ``place`` holds the set's size ``n``
    and, in the lower half, ``at``; ``n - at`` is the most that it can share with another set if the
    key is the first that they share."""

    def keys_of(found):
        n = len(found)
        p = n - _need(n, s) + 1
        if n < 2:
            return [], []
        keys, at = [], []
        if n <= light:
            first, second = np.triu_indices(min(p + 1, n), 1)
            both = np.stack([found[first], found[second]], 1)
            both.sort(1)
            values, _ = grams(both.ravel(), np.array([0, both.size]), 2, 500)
            keys.append(values[::2])
            at.append(second - 1)
        if 100 * n >= s.percent * (light + 1):
            keys.append(found[:p])
            at.append(np.arange(p))
        return keys, at

    def post(batches):
        for batch in batches:
            for _, data, offsets in slices(column_of(batch, "text")):
                keys, nodes, places, seen = [], [], [], set()
                for _, found in _sets(data, offsets, s.width):
                    if not len(found) or (node := _node(found)) in seen:
                        continue
                    seen.add(node)
                    k, a = keys_of(order.value.ordered(found)[0])
                    for x, y in zip(k, a, strict=True):
                        keys.append(x)
                        nodes.append(np.full(len(x), node))
                        places.append(y.astype(np.int64) | len(found) << 32)
                if keys:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(nodes)),
                         pa.array(np.concatenate(places))],
                        names=["key", "node", "place"],
                    )

    return docs.select("text").mapInArrow(post, "key long, node long, place long")


def _possible(s: Settings):
    """Whether sizes and positions allow a link between sets at ``place`` and at ``there``."""
    (n, at), (m, bt) = (
        (F.shiftright(c, 32), F.col(c).bitwiseAND(F.lit((1 << 32) - 1).cast("long"))) for c in ("place", "there")
    )
    most = F.least(n - at, m - bt)
    return (F.lit(100) * F.least(n, m) >= s.percent * F.greatest(n, m)) & (
        (100 + s.percent) * most >= s.percent * (n + m)
    )


def _parities(found: np.ndarray) -> bytes:
    """A bit for each of about as many ranges of hashes as there are elements: whether the range holds
    an odd number of them. Ranges in which two sets differ are at most their different elements."""
    power = max(6, len(found).bit_length())
    counts = np.bincount((found >> np.uint64(64 - power)).astype(np.int64), minlength=1 << power)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def _differing(x: np.ndarray, y: np.ndarray) -> int:
    """Ranges with different parity; of two resolutions the finer one is brought to the coarser."""
    x, y = np.unpackbits(x), np.unpackbits(y)
    if len(x) > len(y):
        x, y = y, x
    y = y.reshape(len(x), -1).sum(1) & 1
    return int((x != y).sum())


def _pairwise(pairs: DataFrame, sets: DataFrame, column: str, test) -> DataFrame:
    """The pairs whose two values of ``column`` and sizes pass ``test``."""

    def compare(batches):
        for batch in batches:
            rows = zip(*[column_of(batch, n) for n in ("left", "right", "n", "m")], strict=True)
            kind = np.uint64 if column == "items" else np.uint8
            keep = [
                test(np.frombuffer(x.as_buffer(), kind), np.frombuffer(y.as_buffer(), kind), n.as_py(), m.as_py())
                for x, y, n, m in rows
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    lefts = sets.select(F.col("node").alias("a"), F.col(column).alias("left"), "n")
    rights = sets.select(F.col("node").alias("b"), F.col(column).alias("right"), F.col("n").alias("m"))
    both = pairs.join(lefts, "a").join(rights, "b").select("a", "b", "left", "right", "n", "m")
    return written(both.mapInArrow(compare, "a long, b long").distinct(), "compared")[0]


def _verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame, s: Settings) -> DataFrame:
    """The pairs (``a, b``) of nodes that are similar enough: by parities, a hundredth of a set's size,
    then by the whole sets of what is left."""
    spark = docs.sparkSession
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted, path = written(classes.join(nodes, "node", "left_semi").select("doc_id").distinct(), "wanted")
    small = wanted.count() <= BROADCAST_IDS
    texts = docs.join(F.broadcast(wanted) if small else wanted, docs["doc_id"].eqNullSafe(wanted["doc_id"]), "left_semi")

    def sets_of(batches):
        for batch in batches:
            for _, data, offsets in slices(column_of(batch, "text")):
                found = [x for _, x in _sets(data, offsets, s.width)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_node(x) for x in found], pa.int64()), pa.array([len(x) for x in found], pa.int64()),
                     binary_array([_parities(x) for x in found]), binary_array([x.tobytes() for x in found])],
                    names=["node", "n", "parities", "items"],
                )

    def near(x, y, n, m):
        return (100 + s.percent) * _differing(x, y) <= (100 - s.percent) * (n + m)

    def similar(x, y, n, m):
        few, many = (x, y) if n < m else (y, x)
        both = int((many[np.minimum(np.searchsorted(many, few), len(many) - 1)] == few).sum())
        return 100 * both >= s.percent * (n + m - both)

    made = texts.select("text").mapInArrow(sets_of, "node long, n long, parities binary, items binary")
    sets, sets_path = written(made, "sets")
    left = _pairwise(pairs, sets, "parities", near)
    ends = left.select(F.col("a").alias("node")).union(left.select("b")).distinct()
    links = _pairwise(left, sets.join(ends, "node", "left_semi"), "items", similar)
    for old in (path, sets_path):
        dropped(spark, old)
    return links


def _rooted(docs: DataFrame, s: Settings) -> DataFrame:
    """``doc_id, n_shingles, component_id, text_key, root``. Components have different roots, even if
    their smallest ``doc_id`` is the same; without words there is none."""
    spark = docs.sparkSession
    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    described = shingle_sets(docs.select(doc_id, text_key(F.col("text")).alias("text_key"), "text"), s)
    described, _ = written(described, "described")
    docs = docs.select(doc_id, "text")
    classes, _ = written(
        described.where("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id")), "classes"
    )
    order = spark.sparkContext.broadcast(_Order(*_frequent(docs, s), s.share))
    light = _boundary(docs, order, s)
    postings, postings_path = written(_postings(docs, order, light, s), "postings")

    # Most keys occur once. What is left is read again below.
    lists = postings.groupBy("key").agg(F.count("*").alias("n"))
    lists, _ = written(lists.where("n > 1").select("key"), "lists")
    several, _ = written(postings.join(lists, "key"), "several")
    dropped(spark, postings_path)
    # The member that has the smallest share of itself before the key, and among those one by its id.
    share = (F.col("place").bitwiseAND(F.lit((1 << 32) - 1).cast("long")) * 1000 / F.shiftright("place", 32)).cast("long")
    rank = F.shiftleft(share, 50).bitwiseOR(F.shiftrightunsigned("node", 14))
    centres = several.groupBy("key").agg(
        F.min_by("node", rank).alias("other"), F.min_by("place", rank).alias("there"),
        F.min("node").alias("low"), F.max("node").alias("high"),
    )
    # Keys of one class alone came from copies in several tasks.
    centres, _ = written(centres.where("low <> high").drop("low", "high"), "centres")
    shared, _ = written(several.join(centres, "key"), "shared")
    pair = (F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
    first, _ = written(
        shared.where((F.col("node") != F.col("other")) & _possible(s)).select(*pair).distinct(), "pairs"
    )
    links = _verified(docs, classes, first, s)
    roots = components(links)
    few = roots.count() <= BROADCAST_IDS

    def rooted(df, node, root):
        named = roots.select(F.col("node").alias(node), F.col("root").alias(root))
        named = F.broadcast(named) if few else named
        return df.join(named, node, "left").withColumn(root, F.coalesce(root, node))

    placed, _ = written(rooted(rooted(shared, "node", "root"), "other", "centre"), "placed")
    away = placed.where("root <> centre").select("key", "node", "place", "root").distinct()
    members = placed.select(
        "key", F.col("node").alias("other"), F.col("place").alias("there"), F.col("root").alias("far")
    )
    rest = away.join(members, "key").where((F.col("root") != F.col("far")) & _possible(s)).select(*pair)
    second, _ = written(rest.distinct().join(first, ["a", "b"], "left_anti"), "pairs")
    if not second.isEmpty():
        more = _verified(docs, classes, second, s)
        roots = components(links.union(more))
        few = roots.count() <= BROADCAST_IDS
    named = rooted(classes, "node", "root")
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    least, _ = written(least, "least")
    named, _ = written(named.join(least, "root").select("node", "component_id", "root"), "named")
    return described.join(named, "node", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        "text_key",
        "root",
    )


def similar_components(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """``doc_id, n_shingles, component_id, text_key``: a row per document with the smallest
    ``doc_id`` that links reach."""
    return _rooted(docs, settings or Settings()).drop("root")


def one_of_each(docs: DataFrame, settings: Settings | None = None) -> DataFrame:
    """``docs`` with the first document of each component, by ``doc_id`` (NULL last) and then by
    ``text_key``, and one of repeated rows. Texts without words that have no ``doc_id`` all stay.
    """
    found, _ = written(_rooted(docs, settings or Settings()), "components")
    rank = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_key")
    first, _ = written(found.where("root IS NOT NULL").groupBy("root").agg(F.min(rank).alias("first")), "first")
    gone = found.join(first, "root").where(~rank.eqNullSafe(F.col("first")))
    kept = without(docs, gone.select("doc_id", "text_key"))
    again = found.groupBy("doc_id", "text_key").agg(F.count("*").alias("n"), F.max("n_shingles").alias("size"))
    again = again.where("n > 1 AND (doc_id IS NOT NULL OR size > 0)")
    again, _ = written(again.select("doc_id", "text_key"), "repeated")
    if again.isEmpty():
        return kept
    repeated = without(kept, again, keep=True).dropDuplicates(["doc_id", "text"])
    return without(kept, again).unionByName(repeated)
