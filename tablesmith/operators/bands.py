"""Items that ask for a range of a column meet its rows by blocks or by tiles.

**Reads** need every item of a row. The column is cut into blocks of about ``ROWS_PER_BLOCK`` rows, each an array in
one row. An item has every row of the blocks inside its range, and looks at the rows of the two blocks it ends in.
Items and blocks meet in an equi join on parts of ``BLOCKS_PER_PART`` blocks: an item is sent once for each part of
which it takes rows, a row once for each chunk of its part's items. The result is never held.

**Changes** use tiles. Every 64th bound of the items (at most ``EDGES`` of them) is an edge. The edges cut the column into
tiles: the gaps between them and the edges themselves, so a bound that many items share is a tile of
its own. A range covers some tiles as a whole, and at most two gaps in part. The whole tiles of an item are the fewest
nodes of a binary tree over the tiles, so a range that covers everything is two dozen entries, not one per tile.

* **Deletes** need the first item of a row: a step function over the tiles, the least item that covers
  each as a whole, and again the few items that end in the gap. One search per row.
* **Updates** need the last item of a row that sets a column, found like the first of a delete.
* **Counts** are differences of ranks: how many rows lie below each end of an item's range.
* **The first rows of each item**, in an order that begins with the column, lie next to each other in that order:
  an item takes them by their places.

Rows and items meet in an equi join on tiles. Rows stay where they are if the items' side is proven small.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.predicates import Condition, predicate
from ..functions.values import col
from ..sources.items import ITEM, Bound, index_items
from ..sources.scratch import fits_broadcast, pinned
from .matching import array_predicate

#: Bounds per gap, and the most edges: one array of them goes to every task.
PER_GAP = 64
EDGES = 1 << 20
#: Rows of a block, and blocks that an item meets together: about 32,000 rows.
ROWS_PER_BLOCK = 128
BLOCKS_PER_PART = 256
#: Items and rows of the result for a task, if the blocks are broadcast; rows of the result for a chunk of the items of
#: a part, if not; and the most tasks.
ITEMS_PER_CHUNK = 1024
ROWS_PER_TASK = 1 << 22
ROWS_PER_CHUNK = 1 << 28
MOST_TASKS = 1 << 14

_LOWER = {"greaterThan": True, "greaterThanOrEqual": False}
_UPPER = {"lessThan": True, "lessThanOrEqual": False}
#: Types whose values are compared as numbers, and how they become some.
_NUMBERS = {
    T.IntegralType: lambda v: v.cast("long"),
    T.FloatType: lambda v: v.cast("double"),
    T.DoubleType: lambda v: v.cast("double"),
    T.DateType: lambda v: F.unix_date(v).cast("long"),
    T.TimestampType: F.unix_micros,
}
_TILE, _NODE, _HELD = "__tile", "__node", "__held"


@dataclass(frozen=True)
class Band:
    """A column and the positions of the conditions that bound it from below and above."""

    column: str
    lower: int | None
    upper: int | None


def band_match(conditions: Sequence[Condition], combine: str) -> Band | None:
    """The ranges a template asks for: all its conditions hold together, and one of them at least
    compares a column with a value of the item."""
    if combine != "AND" and len(conditions) > 1:
        return None
    found: dict[str, Band] = {}
    for i, condition in enumerate(conditions):
        band = found.get(condition.column, Band(condition.column, None, None))
        if condition.uses_item and condition.operator in _LOWER and band.lower is None:
            found[condition.column] = Band(band.column, i, band.upper)
        elif condition.uses_item and condition.operator in _UPPER and band.upper is None:
            found[condition.column] = Band(band.column, band.lower, i)
    both = [band for band in found.values() if band.lower is not None and band.upper is not None]
    return next(iter([*both, *found.values()]), None)


def only_band(conditions: Sequence[Condition], band: Band) -> bool:
    """Whether the range is all that an item asks for."""
    return all(i in (band.lower, band.upper) for i, c in enumerate(conditions) if c.uses_item)


class Tiles:
    """The edges of a set of items, and where items and rows lie between them."""

    def __init__(self, bound: Bound, conditions: Sequence[Condition], band: Band):
        self.conditions, self.band = conditions, band
        bounds = [i for i in (band.lower, band.upper) if i is not None]
        present = [F.col(f"__w{i}").isNotNull() for i in bounds]
        items = bound.valid
        for test in present:
            items = items.where(test)
        self.items = pinned(items)
        ends = self.items.select(F.explode(F.array(*[F.col(f"__w{i}") for i in bounds])).alias("v"))
        numbered = index_items(ends, ["v"], "at")
        step = max(PER_GAP, -(-(self.items.count() * len(bounds)) // EDGES))
        chosen = numbered.where(F.col("at") % step == step // 2).select("v").distinct()
        self.n_edges = chosen.count()
        self._chosen = chosen
        self._edges = chosen.agg(F.sort_array(F.collect_list("v")).alias("edges"))
        #: Levels of the tree: a node of level l holds 2^l tiles.
        self.levels = (2 * self.n_edges + 1).bit_length()

    def placed(self, df: DataFrame, values: dict[str, Column]) -> DataFrame:
        """Adds the tile of each value: even for a gap, odd for an edge."""
        names = df.columns
        whole = self._chosen.schema["v"].dataType
        kinds = {n: df.select(F.coalesce(v, F.lit(None).cast(whole)).alias("v")).schema["v"].dataType for n, v in values.items()}
        if all(isinstance(kind, tuple(_NUMBERS)) for kind in kinds.values()):
            return df.select(*[col(n) for n in names], *[self._searched(v, kinds[n]).alias(n) for n, v in values.items()])
        df = df.withColumn("__edges", self._edges.scalar())
        for name, value in values.items():
            df = df.withColumn("__below", _halved(value, self.n_edges))
            on_edge = F.coalesce(F.get("__edges", F.col("__below")) == value, F.lit(False))
            df = df.withColumn(name, 2 * F.col("__below") + on_edge.cast("int")).drop("__below")
        return df.select(*[col(n) for n in names], *values)

    def _searched(self, value: Column, kind: T.DataType) -> Column:
        """The tile of a value that is compared as a number. NULL lies in the first."""
        number = next(f for t, f in _NUMBERS.items() if isinstance(kind, t))
        edges = self._chosen.select(number(F.col("v").cast(kind)).alias("v")).toArrow()["v"].to_numpy()
        shared = self.items.sparkSession.sparkContext.broadcast(np.sort(edges))

        def tiles(values: pd.Series) -> pd.Series:
            edges, values = shared.value, values.to_numpy()
            below = np.searchsorted(edges, values)
            if not len(edges):
                return pd.Series(below.astype(np.int32))
            there = edges[np.minimum(below, len(edges) - 1)]
            same = (below < len(edges)) & ((there == values) | ((there != there) & (values != values)))
            return pd.Series((2 * below + same).astype(np.int32))

        found = F.pandas_udf(tiles, "int")(F.coalesce(number(value.cast(kind)), F.lit(0)))
        return F.when(value.isNull(), F.lit(0)).otherwise(found)

    @cached_property
    def spans(self) -> DataFrame:
        """Each item with the tiles it covers as a whole, ``a`` to ``b``, and the gaps it ends in."""
        lower, upper = self.band.lower, self.band.upper
        ends = {f"__t{i}": F.col(f"__w{i}") for i in (lower, upper) if i is not None}
        items = self.placed(self.items, ends)
        first, last, gaps = F.lit(0), F.lit(2 * self.n_edges), []
        for i, strict, below in ((lower, _LOWER, True), (upper, _UPPER, False)):
            if i is None:
                continue
            tile = F.col(f"__t{i}")
            gap = tile % 2 == 0
            inside = F.lit(0) if not strict[self.conditions[i].operator] else F.lit(1)
            # A gap is covered in part; an edge belongs to the range unless that is strict.
            shift = F.when(gap, F.lit(1)).otherwise(inside)
            if below:
                first = tile + shift
            else:
                last = tile - shift
            gaps.append(F.when(gap, tile))
        spans = items.select(
            *self.items.columns,
            first.cast("int").alias("a"),
            last.cast("int").alias("b"),
            F.array_distinct(F.filter(F.array(*gaps), lambda t: t.isNotNull())).alias("gaps"),
        ).where("a <= b or size(gaps) > 0")
        return pinned(spans)

    def nodes(self, spans: DataFrame) -> DataFrame:
        """A row per item and node that its whole tiles are made of."""

        # Of each level the first and the last node inside the range, but for those whose parent is inside, too.
        levels = spans.where("a <= b").withColumn("l", F.explode(F.sequence(F.lit(0), F.lit(self.levels))))
        levels = levels.withColumn("low", F.expr("shiftright(a + shiftleft(1L, l) - 1, l)"))
        levels = levels.withColumn("high", F.expr("shiftright(b + 1L, l) - 1")).where("low <= high")
        inside = "({0} % 2 = 0 AND {0} < high OR {0} % 2 = 1 AND {0} > low)"
        nodes = [F.expr(f"CASE WHEN {test} AND NOT {inside.format(x)} THEN {x} END") for x, test in (("low", "true"), ("high", "low < high"))]
        nodes = levels.select("*", F.explode(F.array(*nodes)).alias("x")).where("x IS NOT NULL")
        nodes = nodes.withColumn(_NODE, self.node(F.col("l"), F.col("x")))
        return nodes.drop("a", "b", "gaps", "l", "low", "high", "x")

    def node(self, level: Column, x: Column) -> Column:
        return level.cast("long") * (1 << 40) + x.cast("long")

    def above(self) -> Column:
        """The nodes that hold a tile."""
        tile = F.col(_TILE).cast("long")
        return F.array(*[self.node(F.lit(l), F.shiftright(tile, l)) for l in range(self.levels + 1)])

    def over_nodes(self, per_node: DataFrame) -> DataFrame:
        """A row per tile and node above it that ``per_node`` has."""
        every = per_node.sparkSession.range(2 * self.n_edges + 1).select(F.col("id").alias(_TILE))
        return every.select(_TILE, F.explode(self.above()).alias(_NODE)).join(per_node, _NODE)

    def ends(self, spans: DataFrame) -> DataFrame:
        """The items that end in each gap."""
        fields = F.struct(ITEM, *[c for c in self.items.columns if c != ITEM])
        ends = spans.select(F.explode(F.col("gaps").cast("array<bigint>")).alias(_TILE), fields.alias("i"))
        return ends.groupBy(_TILE).agg(F.collect_list("i").alias(_HELD))

    def stepped(self, df: DataFrame, covered: DataFrame, spans: DataFrame) -> DataFrame:
        """All rows with what holds for their whole tile and with the items that end in it."""
        steps = pinned(covered.join(self.ends(spans), _TILE, "full"))
        rows = self.placed(df, {_TILE: col(self.band.column)}).withColumn(_TILE, F.col(_TILE).cast("long"))
        return rows.join(F.broadcast(steps) if fits_broadcast(steps) else steps, _TILE, "left")


class Blocks:
    """Rows cut by a column into blocks. Edges are values of about every ``ROWS_PER_BLOCK``th row, chosen by a hash
    of its place, and the least and the largest. Block ``j`` lies between edges ``j - 1`` and ``j`` and may hold both;
    a value that many rows share is an edge several times and fills the blocks between."""

    def __init__(self, rows: DataFrame, band: Band):
        values = rows.select(col(band.column).alias("v"))
        ends = pinned(values.agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")))
        step = max(ROWS_PER_BLOCK, -(-ends.first().n // EDGES))
        chosen = values.where(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(step)) == 0)
        both = ends.where("n > 0").select(F.explode(F.array("low", "high")).alias("v"))
        self.edges = pinned(chosen.unionAll(both))
        self.n_edges = self.edges.count()

    def searched(self, df: DataFrame, values: dict[str, tuple[Column, bool]]) -> DataFrame:
        """Adds how many edges lie below each value or, with ``True``, below and at it."""
        names, whole = [col(n) for n in df.columns], self.edges.schema["v"].dataType
        kinds = {n: df.select(F.coalesce(v, F.lit(None).cast(whole)).alias("v")).schema["v"].dataType for n, (v, _) in values.items()}
        if all(isinstance(kind, tuple(_NUMBERS)) for kind in kinds.values()):
            found = [self._among_numbers(v, kinds[n], upto).alias(n) for n, (v, upto) in values.items()]
            return df.select(*names, *found)
        df = df.withColumn("__edges", self.edges.agg(F.sort_array(F.collect_list("v")).alias("edges")).scalar())
        return df.select(*names, *[_halved(v, self.n_edges, upto).cast("long").alias(n) for n, (v, upto) in values.items()])

    def _among_numbers(self, value: Column, kind: T.DataType, upto: bool) -> Column:
        number = next(f for t, f in _NUMBERS.items() if isinstance(kind, t))
        edges = self.edges.select(number(F.col("v").cast(kind)).alias("v")).toArrow()["v"].to_numpy()
        shared = self.edges.sparkSession.sparkContext.broadcast(np.sort(edges))

        def below(values: pd.Series) -> pd.Series:
            return pd.Series(np.searchsorted(shared.value, values.to_numpy(), "right" if upto else "left").astype(np.int64))

        return F.pandas_udf(below, "long")(F.coalesce(number(value.cast(kind)), F.lit(0)))

    def dealt(self, rows: DataFrame, column: str) -> DataFrame:
        """A row per block: ``__part``, ``__block`` and its rows, an array of structs of ``c0``, ``c1`` and so on."""
        fields = F.struct(*[col(name).alias(f"c{i}") for i, name in enumerate(rows.columns)])
        rows = self.searched(rows, {"__below": (col(column), False), "__upto": (col(column), True)})
        first, last = F.greatest("__below", F.lit(1)), F.least("__upto", F.lit(self.n_edges - 1))
        block = first + F.pmod(F.monotonically_increasing_id(), last - first + 1)
        rows = rows.select(block.alias("__block"), fields.alias("r")).withColumn("__part", self.part(F.col("__block")))
        return rows.groupBy("__part", "__block").agg(F.collect_list("r").alias(_HELD))

    def part(self, block: Column) -> Column:
        return F.floor(block / BLOCKS_PER_PART)

    def chunks(self, copies: DataFrame) -> tuple[DataFrame, int]:
        """Over how many chunks the items of each part are dealt, by the rows they will give, and over how many
        tasks all chunks. There are ``EDGES / BLOCKS_PER_PART`` parts at most. Each chunk meets all rows of its part."""
        start = F.col("__part") * BLOCKS_PER_PART
        own = F.least(F.col("__last"), start + (BLOCKS_PER_PART - 1)) - F.greatest(F.col("__first"), start) + 1
        chunks = F.ceil(F.sum(own) * ROWS_PER_BLOCK / ROWS_PER_CHUNK).cast("int").alias("__chunks")
        loads = pinned(copies.groupBy("__part").agg(chunks))
        return loads, max(1, min(MOST_TASKS, loads.agg(F.sum("__chunks")).first()[0] or 0))


def select_by_bands(
    df: DataFrame, bound: Bound, where: Sequence[Condition], band: Band
) -> DataFrame:
    """Every row with every item that asks for it, as column ``item``."""
    rows = df.where(_asked(df, where, band))
    blocks = Blocks(rows, band)
    lower, upper = band.lower, band.upper
    items = bound.valid
    for i in (lower, upper):
        items = items if i is None else items.where(F.col(f"__w{i}").isNotNull())
    if not blocks.n_edges:
        return items.select(F.col(ITEM).alias("item"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema]).where("false")
    # An item covers the blocks between the two that it ends in.
    ends = {}
    if lower is not None:
        ends["__from"] = F.col(f"__w{lower}"), _LOWER[where[lower].operator]
    if upper is not None:
        ends["__to"] = F.col(f"__w{upper}"), not _UPPER[where[upper].operator]
    items = blocks.searched(items, ends)
    items = items if lower is not None else items.withColumn("__from", F.lit(0).cast("long"))
    items = items if upper is not None else items.withColumn("__to", F.lit(blocks.n_edges).cast("long"))
    items = items.withColumn("__first", F.greatest("__from", F.lit(1))).withColumn("__last", F.least("__to", F.lit(blocks.n_edges - 1)))
    items = items.where("__first <= __last")
    small = fits_broadcast(rows)
    items = items.repartition(_tasks(items)) if small else items
    copies = items.withColumn("__part", F.explode(F.sequence(blocks.part(F.col("__first")), blocks.part(F.col("__last")))))
    held = blocks.dealt(rows, band.column)
    if small:
        copies, held = copies.withColumn("__chunk", F.lit(0)), F.broadcast(held.withColumn("__c", F.lit(0)))
    else:
        chunks, tasks = blocks.chunks(copies)
        copies = copies.join(F.broadcast(chunks), "__part")
        copies = copies.withColumn("__chunk", F.pmod(F.monotonically_increasing_id(), F.col("__chunks")).cast("int"))
        copies = copies.drop("__chunks").repartition(tasks, "__part", "__chunk")
        held = held.join(F.broadcast(chunks), "__part").withColumn("__c", F.explode(F.sequence(F.lit(0), F.col("__chunks") - 1)))
        held = held.drop("__chunks").repartition(tasks, "__part", "__c")
    held = held.withColumnRenamed("__part", "__p")
    same = (F.col("__part") == F.col("__p")) & (F.col("__chunk") == F.col("__c"))
    met = copies.join(held, same & F.col("__block").between(F.col("__first"), F.col("__last")))
    at = {name: f"c{i}" for i, name in enumerate(df.columns)}

    def asked(row: Column) -> Column:
        test = predicate(
            df.schema, where, "AND", column_of=lambda name: row.getField(at[name]), item_value=lambda i: F.col(f"__w{i}")
        )
        return F.coalesce(test, F.lit(False))

    found = F.filter(_HELD, asked)
    if only_band(where, band):
        inside = (F.col("__block") > F.col("__from")) & (F.col("__block") < F.col("__to"))
        found = F.when(inside, F.col(_HELD)).otherwise(found)
    # Outer, or Spark would look for empty arrays in the join's condition, before it has compared blocks.
    met = met.select(F.col(ITEM).alias("__i"), F.explode_outer(found).alias("__r")).where("__r IS NOT NULL")
    return met.select(F.col("__i").alias("item"), *[F.col("__r").getField(at[name]).alias(name) for name in df.columns])


def _tasks(items: DataFrame) -> int:
    """Over how many tasks items are dealt that meet their blocks where they are: by the rows they will give."""
    sizes = items.agg(F.count("*").alias("n"), F.sum(F.col("__last") - F.col("__first") + 1).alias("blocks")).first()
    few = min(items.sparkSession.sparkContext.defaultParallelism, -(-sizes.n // ITEMS_PER_CHUNK))
    return max(1, few, min(MOST_TASKS, (sizes.blocks or 0) * ROWS_PER_BLOCK // ROWS_PER_TASK))


def _halved(value: Column, n: int, upto: bool = False) -> Column:
    """How many of the ``n`` sorted values in ``__edges`` lie below the value (or also at it), by halving."""
    span = F.struct(F.lit(0).alias("low"), F.lit(n).alias("high"))
    steps = F.sequence(F.lit(0), F.lit(n.bit_length()))

    def halve(s, _):
        middle = F.floor((s["low"] + s["high"]) / 2).cast("int")
        edge = F.get("__edges", middle)
        less = F.coalesce(edge <= value if upto else edge < value, F.lit(False))
        searched = F.struct(
            F.when(less, middle + 1).otherwise(s["low"]).alias("low"),
            F.when(less, s["high"]).otherwise(middle).alias("high"),
        )
        return F.when(s["low"] < s["high"], searched).otherwise(s)

    return F.aggregate(steps, span, halve, lambda s: s["low"])


def _ranks(df: DataFrame, column: str, bounds: DataFrame) -> DataFrame:
    """Each value ``v`` of the bounds and of the column with the number of rows ``before`` it, and with those
    that hold it, ``upto`` it. The driver sees one number per partition."""
    values = df.select(col(column).alias("v"), F.lit(1).cast("long").alias("n"))
    values = values.union(bounds.select("v", F.lit(0).cast("long")))
    values = values.groupBy("v").agg(F.sum("n").alias("n"))
    slices = values.repartitionByRange("v").withColumn("__slice", F.spark_partition_id())
    slices = pinned(slices)
    totals = sorted(slices.groupBy("__slice").agg(F.sum("n").alias("n")).collect())
    starts = [(row[0], sum(before[1] for before in totals[:k])) for k, row in enumerate(totals)]
    starts = df.sparkSession.createDataFrame(starts, "__slice int, __start bigint")
    running = F.sum("n").over(Window.partitionBy("__slice").orderBy("v"))
    ranked = slices.withColumn("upto", running).join(F.broadcast(starts), "__slice")
    upto = F.col("__start") + F.col("upto")
    return ranked.select("v", (upto - F.col("n")).alias("before"), upto.alias("upto"))


def _between(rows: DataFrame, items: DataFrame, where: Sequence[Condition], band: Band) -> DataFrame:
    """Items with the numbers of rows below their range, ``__from``, and up to its end, ``__to``. The rows hold
    no NULL in the band's column."""
    ends = [i for i in (band.lower, band.upper) if i is not None]
    for i in ends:
        items = items.where(F.col(f"__w{i}").isNotNull())
    items = pinned(items)
    bounds = items.select(F.explode(F.array(*[F.col(f"__w{i}") for i in ends])).alias("v"))
    ranks = pinned(_ranks(rows, band.column, bounds.distinct()))
    names = {band.lower: "__from", band.upper: "__to"}
    for i in ends:
        rank = "upto" if where[i].operator in ("greaterThan", "lessThanOrEqual") else "before"
        side = ranks.select(F.col("v").alias("__v"), F.col(rank).alias(names[i]))
        items = items.join(side, F.col(f"__w{i}") == F.col("__v")).drop("__v")
    if band.lower is None:
        items = items.withColumn("__from", F.lit(0).cast("long"))
    if band.upper is None:
        items = items.withColumn("__to", F.lit(rows.count()))
    return items.where("__from < __to")


def first_rows_by_bands(
    df: DataFrame, bound: Bound, where: Sequence[Condition], band: Band, ordering: Sequence[Column], falling: bool, n: int
) -> DataFrame:
    """Every item with the first ``n`` rows that it asks for. ``ordering`` begins with the band's column,
    ``falling`` or rising; the range is all that an item asks for."""
    rows = pinned(df.where(_asked(df, where, band)))
    items = _between(rows, bound.valid, where, band)
    # Of rows in falling order those above the range come first.
    first = F.lit(rows.count()) - F.col("__to") if falling else F.col("__from")
    taken = F.least(F.lit(n).cast("long"), F.col("__to") - F.col("__from"))
    places = items.select(F.col(ITEM).alias("item"), F.explode(F.sequence(first, first + taken - 1)).alias("__place"))
    return index_items(rows, ordering, "__place").join(places, "__place").select("item", *[col(c) for c in df.columns])


def first_by_bands(
    df: DataFrame, bound: Bound, where: Sequence[Condition], band: Band, name: str
) -> DataFrame:
    """All rows with the least item that asks for each, NULL for none, in column ``name``."""
    tiles = Tiles(bound, where, band)
    spans = tiles.spans
    # The least item over each node, then over the nodes above each tile.
    least = tiles.nodes(spans).groupBy(_NODE).agg(F.min(ITEM).alias("least"))
    covered = tiles.over_nodes(least).groupBy(_TILE).agg(F.min("least").alias("__whole"))
    rows = tiles.stepped(df, covered, spans)
    inside = F.filter(_HELD, lambda x: array_predicate(df.schema, where, "AND", x))
    found = F.least(F.col("__whole"), F.array_min(inside.getField(ITEM)))
    return rows.select(*[col(c) for c in df.columns], F.when(_asked(df, where, band), found).alias(name))


def last_by_bands(
    df: DataFrame, tiles: Tiles, where: Sequence[Condition], columns: Sequence[int]
) -> DataFrame:
    """All rows with, per mapped column j, what the last item that asks for the row and sets the column
    gives it, ``__v<j>`` with field ``v``; NULL for none."""
    spans = tiles.spans
    # The last item over each node, then over the nodes above each tile, then what it sets.
    last = [F.max(F.when(F.col(f"__h{j}"), F.col(ITEM))).alias(f"__p{j}") for j in columns]
    per_node = tiles.nodes(spans).groupBy(_NODE).agg(*last)
    covered = tiles.over_nodes(per_node).groupBy(_TILE).agg(*[F.max(f"__p{j}").alias(f"__p{j}") for j in columns])
    covered = pinned(covered)
    for j in columns:
        given = tiles.items.where(f"__h{j}").select(F.col(ITEM).alias("at"), F.col(f"__s{j}").alias("v"))
        given = given.join(covered.select(F.col(f"__p{j}").alias("at")).distinct(), "at", "left_semi")
        given = given.dropDuplicates(["at"]).select("at", F.struct("at", "v").alias("__given"))
        covered = covered.join(given, F.col(f"__p{j}") == F.col("at"), "left").withColumn(f"__p{j}", F.col("__given"))
        covered = covered.drop("at", "__given")
    rows = tiles.stepped(df, covered, spans)
    rows = rows.withColumn(_HELD, F.filter(_HELD, lambda x: array_predicate(df.schema, where, "AND", x)))

    def later(a, x):
        return F.when(a.isNull() | (x["at"] > a["at"]), x).otherwise(a)

    def value(j: int) -> Column:
        ends = F.filter(_HELD, lambda x: x.getField(f"__h{j}"))
        ends = F.transform(ends, lambda x: F.struct(x.getField(ITEM).alias("at"), x.getField(f"__s{j}").alias("v")))
        best = F.aggregate(F.coalesce(ends, F.filter(F.array(f"__p{j}"), lambda x: F.lit(False))), F.col(f"__p{j}"), later)
        return F.when(_asked(df, where, tiles.band), best).alias(f"__v{j}")

    return rows.select(*[col(c) for c in df.columns], *[value(j) for j in columns])


def counts_by_bands(df: DataFrame, items: DataFrame, where: Sequence[Condition], band: Band) -> DataFrame:
    """How many rows each item asks for (``item``, ``affectedRows``), for those that ask for any."""
    found = _between(df.where(_asked(df, where, band)), items, where, band)
    return found.groupBy(F.col(ITEM).alias("item")).agg(F.sum(F.col("__to") - F.col("__from")).alias("affectedRows"))


def _asked(df: DataFrame, where: Sequence[Condition], band: Band) -> Column:
    """What every item asks of a row."""
    plain = [c for c in where if not c.uses_item]
    asked = col(band.column).isNotNull()
    return asked & predicate(df.schema, plain) if plain else asked
