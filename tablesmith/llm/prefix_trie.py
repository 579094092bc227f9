"""Prefix trie of conversations, its subtree totals rolled up by bands of depth.

A node of depth d is a distinct sequence of first d turns (role, text). It is known by its depth and
128 bits: the exclusive or of a hash of every turn together with its place. That can be taken in any
grouping, so a conversation that holds a third of all turns is cut over many tasks like any other.

Totals of subtrees go up in bands of ``Settings.band`` depths. Inside a band the turns of one
conversation (never more than the band is high) sum what lies below each of them, and the sums meet
per node. The tops of the bands form a trie that is ``band`` times lower and is solved the same way;
its completed totals then enter the bands above them. A trie of depth D takes log(D) / log(band)
rounds up and as many down, and no node is ever sent to more than ``band`` ancestors.

Defined results:

* Turns are ordered by ``turn`` (NULL first), then role, then text. NULL roles and texts are empty.
* Rows without a ``conv_id`` belong to no conversation and are left out. Repeated rows are turns of
  their own.
* The base of conversation c is c - c % 100, with the sign of c as in SQL: -5 belongs to 0.
* A conversation that loses all turns is a member of the root and ends there. An empty table has no
  nodes, not even a root.
* Other columns are ignored, whatever their names.
* Two different sequences are taken for one with odds of 2^-128 a pair.

The digest over the ids that end at one node is sequential by its definition: one task reads them, in
blocks that were joined elsewhere and as a stream, so its memory does not grow.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .shared import column_of, dropped, written

KEY = ["d", "a", "b"]
#: Turns that may come from the base conversation: h is below this.
HEADS = 6
#: A conversation's base is the one with the next lower multiple of this.
FAMILY = 100
#: Parents of more than this share of all nodes are broadcast; there can't be more than as many.
HOT_PARENTS = 1024
#: 2^12 neighbouring ids make one block of a digest.
BLOCK_BITS = 12


@dataclass(frozen=True)
class Settings:
    band: int = 16

    def __post_init__(self):
        if self.band < 2:
            raise ValueError("band: 2 at least")


def _turns(conversations: DataFrame) -> DataFrame:
    """Hashes and lengths of all turns in order, with the part they lie in and their place there."""
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("c"),
        F.col("turn").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        # Equal rows can be cut apart.
        F.monotonically_increasing_id().alias("tie"),
    )
    order = [F.col("c"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("tie")]
    placed = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    return placed.select(
        "c",
        F.xxhash64(F.lit(1), "role", "text").alias("ta"),
        F.xxhash64(F.lit(2), "role", "text").alias("tb"),
        F.length("text").cast("long").alias("len"),
        F.monotonically_increasing_id().alias("at"),
    ).select("c", "ta", "tb", "len", F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND((1 << 33) - 1).alias("at"))


def _hash(i: Column, ta: Column, tb: Column) -> tuple[Column, Column]:
    """What turn ``i`` adds to the two halves of a prefix."""
    return F.xxhash64(i, ta, tb), F.xxhash64(F.lit(3), tb, i, ta)


def _runs(turns: DataFrame) -> DataFrame:
    """Per conversation and part: first place, turns there, turns in earlier parts, in all parts."""
    runs = turns.groupBy("c", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    whole = W.partitionBy("c")
    before = whole.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    return runs.select(
        "*",
        F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("before"),
        F.sum("n").over(whole).alias("total"),
    )


def _bases(turns: DataFrame, runs: DataFrame) -> DataFrame:
    """The first turns of every conversation that is a base."""
    base = (F.col("c") % FAMILY == 0) & (F.col("before") < HEADS - 1)
    first = turns.join(runs.where(base), ["part", "c"])
    first = first.withColumn("r", F.col("before") + F.col("at") - F.col("first") + 1).where(f"r < {HEADS}")
    return first.groupBy(F.col("c").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("r", "ta", "tb", "len"))).alias("heads")
    )


def _conversations(runs: DataFrame, bases: DataFrame) -> DataFrame:
    """Per conversation: the turns it takes from its base, how many of its own it drops, its length."""
    conversations = runs.groupBy("c").agg(F.max("total").alias("total")).select(
        "c",
        "total",
        (F.col("c") - F.col("c") % FAMILY).alias("base"),
        (F.crc32(F.col("c").cast("string").cast("binary")) % HEADS).alias("h"),
    )
    taken = F.coalesce(F.slice("heads", F.lit(1), F.col("h").cast("int")), F.array().cast("array<struct<r:long,ta:long,tb:long,len:long>>"))
    joined = conversations.join(bases, "base", "left").select("c", "h", "total", taken.alias("heads"))
    n_heads = F.size("heads").cast("long")
    return joined.select(
        "*", n_heads.alias("n_heads"), (n_heads + F.greatest(F.col("total") - F.col("h"), F.lit(0))).alias("length")
    )


def _prefix(heads: Column, n: Column, half: int) -> Column:
    """One half of the prefix of the first ``n`` of a few turns."""
    return F.aggregate(
        F.slice(heads, F.lit(1), n.cast("int")), F.lit(0).cast("long"), lambda x, t: x.bitwiseXOR(_hash(t["r"], t["ta"], t["tb"])[half])
    )


def _head_members(conversations: DataFrame) -> DataFrame:
    """A row for the root and for every turn that comes from the base."""
    before = F.greatest(F.col("d") - 1, F.lit(0))
    rows = conversations.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_heads"))).alias("d"))
    return rows.select(
        "c",
        "d",
        _prefix(F.col("heads"), F.col("d"), 0).alias("a"),
        _prefix(F.col("heads"), F.col("d"), 1).alias("b"),
        _prefix(F.col("heads"), before, 0).alias("pa"),
        _prefix(F.col("heads"), before, 1).alias("pb"),
        F.when(F.col("d") > 0, F.get("heads", (F.col("d") - 1).cast("int"))["len"]).otherwise(0).alias("len"),
        (F.col("d") == F.col("length")).alias("ends"),
    )


def _tails(turns: DataFrame, runs: DataFrame) -> DataFrame:
    """Every turn that a conversation keeps of its own, with the prefix since the start of its run."""
    found = turns.join(runs, ["part", "c"])
    found = found.withColumn("r", F.col("before") + F.col("at") - F.col("first") + 1).where("r > h")
    found = found.withColumn("d", F.col("n_heads") + F.col("r") - F.col("h"))
    ha, hb = _hash(F.col("d"), F.col("ta"), F.col("tb"))
    run = W.partitionBy("part", "c").orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    found = found.select("*", ha.alias("ha"), hb.alias("hb"))
    return found.select("*", F.bit_xor("ha").over(run).alias("la"), F.bit_xor("hb").over(run).alias("lb"))


def _tail_members(turns: DataFrame, runs: DataFrame, conversations: DataFrame) -> DataFrame:
    facts = conversations.select(
        "c", "h", "n_heads", "length", *[_prefix(F.col("heads"), F.col("n_heads"), k).alias(f"x{k}") for k in (0, 1)]
    )
    runs = runs.join(facts, "c").where("length > n_heads")
    # Only a part's first and last conversation can go on in another part: two rows a part at most.
    ends = _tails(turns, runs.where("total > n")).groupBy("part", "c")
    ends = ends.agg(F.max_by(F.struct("la", "lb"), "at").alias("l"))
    before = W.partitionBy("c").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    carried = ends.select(
        "part", "c", F.bit_xor("l.la").over(before).alias("ca"), F.bit_xor("l.lb").over(before).alias("cb")
    )
    rows = _tails(turns, runs).join(F.broadcast(carried), ["part", "c"], "left")

    def whole(local: str, carry: str, start: str) -> Column:
        return F.col(local).bitwiseXOR(F.coalesce(carry, F.lit(0))).bitwiseXOR(F.col(start))

    rows = rows.withColumns({"a": whole("la", "ca", "x0"), "b": whole("lb", "cb", "x1")})
    return rows.select(
        "c",
        "d",
        "a",
        "b",
        F.col("a").bitwiseXOR(F.col("ha")).alias("pa"),
        F.col("b").bitwiseXOR(F.col("hb")).alias("pb"),
        "len",
        (F.col("d") == F.col("length")).alias("ends"),
    )


def _nodes(members: DataFrame) -> DataFrame:
    """A row per node with its members, its last text's length, its parent's key and its children."""
    nodes = members.groupBy(*KEY).agg(
        F.min("c").alias("c"),
        F.count("*").alias("n_convs"),
        F.max("len").alias("len"),
        F.min("pa").alias("pa"),
        F.min("pb").alias("pb"),
    )
    children = nodes.where("d > 0").groupBy((F.col("d") - 1).alias("d"), F.col("pa").alias("a"), F.col("pb").alias("b"))
    children = children.agg(F.count("*").alias("n_children"))
    return nodes.join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))


def _with_parents(nodes: DataFrame) -> DataFrame:
    """Each node with its parent's smallest member."""
    up = ["d", "pa", "pb"]
    parents = nodes.where("n_children > 0").select(
        (F.col("d") + 1).alias("d"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("c").alias("parent"), "n_children"
    )
    least = nodes.count() // HOT_PARENTS
    hot = parents.where(F.col("n_children") > least)
    own = nodes.join(F.broadcast(hot.drop("n_children")), up, "left")
    rest = own.where("parent is null and d > 0").drop("parent")
    rest = rest.join(parents.where(F.col("n_children") <= least).drop("n_children"), up)
    return own.where("parent is not null or d = 0").unionByName(rest)


def _sums(members: DataFrame, values: DataFrame, entries: DataFrame | None, step: int, band: int) -> DataFrame:
    """Per node of depths divisible by ``step``: the values at and below it in its band, and the totals
    of the ``entries`` (tops of the bands below) under it.

    Values and entries travel with one conversation each. A band of a conversation is at most
    ``band`` turns and sums what lies below each of them before the sums meet per node.
    """
    e = F.expr(f"d div {step}")
    none = F.lit(None).cast("long")
    zero = F.lit(0).cast("long")
    rows = members.where(F.col("d") % step == 0).select(
        "c", e.alias("e"), F.expr(f"d div {step * band}").alias("band"), "d", "a", "b", zero.alias("leaves"), zero.alias("saved")
    )

    def riding(df: DataFrame, up: int) -> DataFrame:
        place = F.expr(f"d div {step * band}") - up
        return df.select("c", e.alias("e"), place.alias("band"), none.alias("d"), none.alias("a"), none.alias("b"), "leaves", "saved")

    rows = rows.unionByName(riding(values, 0))
    if entries is not None:
        rows = rows.unionByName(riding(entries.where("d > 0"), 1))
    below = W.partitionBy("c", "band").orderBy(F.col("e").desc()).rangeBetween(W.unboundedPreceding, 0)
    rows = rows.withColumns({"leaves": F.sum("leaves").over(below), "saved": F.sum("saved").over(below)})
    rows = rows.where("a is not null and (leaves != 0 or saved != 0)")
    return rows.groupBy(*KEY).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.min("c").alias("c"))


def _totals(members: DataFrame, nodes: DataFrame, band: int) -> DataFrame:
    """Per node: childless nodes and saved tokens in its subtree."""
    leaf = (F.col("n_children") == 0).cast("long")
    saved = (F.col("n_convs") - 1) * F.col("len")
    values = [nodes.select("c", *KEY, leaf.alias("leaves"), saved.alias("saved"))]
    deepest = members.agg(F.max("d")).first()[0] or 0
    step = 1
    while step * band <= deepest:
        # The tops of the bands carry on what their bands hold.
        tops = _sums(members, values[-1], None, step, band).where(F.col("d") % (step * band) == 0)
        values.append(written(tops, "trie-band")[0])
        step *= band
    totals = None
    for own in reversed(values):
        found = _sums(members, own, totals, step, band)
        totals = written(found, "trie-totals")[0] if step > 1 else found
        step //= band
    return totals.drop("c")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per node out of its blocks of ids, which come one after the other."""
    key, state = None, None
    for batch in batches:
        done = []
        keys = zip(*[column_of(batch, name).to_pylist() for name in KEY], strict=True)
        for now, ids in zip(keys, column_of(batch, "ids"), strict=True):
            if now != key:
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = now, hashlib.sha256(ids.as_py().encode())
            else:
                state.update(b"," + ids.as_py().encode())
        if done:
            yield _digest_rows(done)
    if key is not None:
        yield _digest_rows([(*key, state.hexdigest())])


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays(
        [*[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3], pa.string())], [*KEY, "ends_sha256"]
    )


def _ends(members: DataFrame) -> DataFrame:
    """Per node where conversations end: the digest of their ids."""
    block = F.shiftright("c", BLOCK_BITS).alias("block")
    blocks = members.where("ends").groupBy(*KEY, block).agg(F.sort_array(F.collect_list("c")).alias("ids"))
    blocks = blocks.select(*KEY, "block", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))
    placed = blocks.repartition(*KEY).sortWithinPartitions(*KEY, "block")
    return placed.drop("block").mapInArrow(_digests, "d long, a long, b long, ends_sha256 string")


def members_of(conversations: DataFrame) -> DataFrame:
    """A row per rebuilt conversation and prefix: ``c``, depth ``d``, the prefix's key ``a``, ``b``, its
    parent's key, the length of its last text, whether the conversation ``ends`` there."""
    turns, at = written(_turns(conversations), "trie-turns")
    runs = _runs(turns)
    convs = _conversations(runs, _bases(turns, runs))
    members = _head_members(convs).unionByName(_tail_members(turns, runs, convs))
    members, _ = written(members, "trie-members")
    dropped(conversations.sparkSession, at)
    return members


def prefix_trie(conversations: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """A row per node of the trie of rebuilt conversations: ``conv_id`` (its smallest member),
    ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` (code
    points that a cache of prefixes would not read again, in its subtree) and ``ends_sha256``."""
    members = members_of(conversations)
    nodes, _ = written(_nodes(members), "trie-nodes")
    totals = _totals(members, nodes, settings.band)
    rows = _with_parents(nodes).join(totals, KEY, "left").join(_ends(members), KEY, "left")
    return rows.select(
        F.col("c").alias("conv_id"),
        F.col("d").alias("depth"),
        F.col("parent").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        F.coalesce("leaves", F.lit(0).cast("long")).alias("n_leaves"),
        F.coalesce("saved", F.lit(0).cast("long")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
