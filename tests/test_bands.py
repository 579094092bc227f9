"""Items that ask for ranges: tiles against plain loops, many items, plans."""

from __future__ import annotations

import operator
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tablesmith import Condition, FromItem, Items
from tablesmith.functions.ordering import SortRule
from tablesmith.operators import bands
from tablesmith.operators.delete import delete_per_item
from tablesmith.operators.select import select_per_item
from tablesmith.operators.update import update_per_item

TESTS = {
    "lessThan": operator.lt,
    "lessThanOrEqual": operator.le,
    "greaterThan": operator.gt,
    "greaterThanOrEqual": operator.ge,
}


def cases(rng, n_rows, n_items, values):
    value = lambda: rng.choice([None, *values]) if rng.random() < 0.1 else rng.choice(values)
    rows = [(i, value(), rng.choice(["x", "y"])) for i in range(n_rows)]
    items = [(7 * i - 3, value(), value(), rng.choice(["x", "y", None])) for i in range(n_items)]
    return rows, items


def holds(row, item, where):
    for condition in where:
        given = condition.value
        value = {"low": item[1], "high": item[2], "s": item[3]}[given.name] if isinstance(given, FromItem) else given
        own = {"id": row[0], "v": row[1], "s": row[2]}[condition.column]
        if own is None or value is None:
            return False
        test = TESTS.get(condition.operator, operator.eq)
        if not test(own, value):
            return False
    return True


TEMPLATES = [
    [Condition("v", "greaterThan", FromItem("low"))],
    [Condition("v", "lessThanOrEqual", FromItem("high")), Condition("id", "lessThan", 150)],
    [Condition("v", "greaterThanOrEqual", FromItem("low")), Condition("v", "lessThan", FromItem("high"))],
    [Condition("v", "greaterThan", FromItem("low")), Condition("s", "equals", FromItem("s"))],
]


@pytest.fixture
def narrow(monkeypatch):
    monkeypatch.setattr(bands, "PER_GAP", 3)
    monkeypatch.setattr(bands, "ITEMS_PER_CHUNK", 5)


@pytest.mark.parametrize("where", TEMPLATES)
@pytest.mark.parametrize("broadcast", [True, False])
def test_ranges_equal_single_statements(spark, narrow, monkeypatch, where, broadcast):
    if not broadcast:
        monkeypatch.setattr(bands, "fits_broadcast", lambda df: False)
    rng = random.Random(len(where) + broadcast)
    rows, items = cases(rng, 200, 60, list(range(12)) + [rng.randint(-1000, 1000) for _ in range(30)])
    df = spark.createDataFrame(rows, "id int, v int, s string")
    batch = Items(spark.createDataFrame(items, "item long, low int, high int, s string"))
    found, _ = select_per_item(df, batch, where)
    expected = [(item[0], *row) for item in items for row in rows if holds(row, item, where)]
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, expected))

    change = delete_per_item(df, batch, where)
    left, counts = list(rows), {}
    for item in items:
        hit = [row for row in left if holds(row, item, where)]
        counts[item[0]] = len(hit)
        left = [row for row in left if row not in hit]
    assert sorted(map(repr, map(tuple, change.image.collect()))) == sorted(map(repr, left))
    assert {r.item: r.affectedRows for r in change.outcome.collect()} == counts

    sets = {"s": FromItem("s"), "n": FromItem("low")}
    wide = df.withColumn("n", F.lit(None).cast("int"))
    change = update_per_item(wide, batch, where, sets=sets)
    image = {row[0]: [row[2], None] for row in rows}
    if not any(c.column == "s" for c in where):
        hits = {item[0]: sum(holds(row, item, where) for row in rows) for item in items}
        for item in items:
            for row in rows:
                if holds(row, item, where):
                    image[row[0]] = [item[3], item[1]]
        assert {r.id: [r.s, r.n] for r in change.image.collect()} == image
        assert {r.item: r.affectedRows for r in change.outcome.collect()} == hits
        assert change.touched.count() == sum(any(holds(row, item, where) for item in items) for row in rows)


@pytest.mark.parametrize(
    "kind, values",
    [
        ("double", [0.0, -0.5, 1e300, float("nan"), 3.25]),
        ("string", ["", "a", "é", "zz", "Z"]),
        ("decimal(10,2)", [Decimal("1.10"), Decimal("-2.00"), Decimal("7.77")]),
    ],
)
def test_types(spark, narrow, kind, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values * 3)], f"id int, v {kind}")
    items = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"item long, low {kind}")
    found, errors = select_per_item(df, Items(items), [Condition("v", "greaterThanOrEqual", FromItem("low"))])
    fine = items.where("low is not null and not low <=> double('NaN')") if kind == "double" else items
    expected = df.join(fine, F.col("v") >= F.col("low")).select("item", "id")
    assert sorted(found.select("item", "id").collect()) == sorted(expected.collect())
    assert errors.count() == items.count() - fine.count()


def test_no_items_and_no_rows(spark):
    where = TEMPLATES[2]
    df = spark.createDataFrame([(1, 5, "x"), (2, None, None)], "id int, v int, s string")
    none = Items(spark.createDataFrame([], "item long, low int, high int, s string"))
    some = Items(spark.createDataFrame([(1, 0, 9, None), (2, 9, 0, None)], "item long, low int, high int, s string"))
    assert select_per_item(df, none, where)[0].collect() == []
    assert delete_per_item(df, none, where).image.count() == 2
    assert [r.item for r in select_per_item(df, some, where)[0].collect()] == [1]
    assert select_per_item(df.where("false"), some, where)[0].collect() == []
    assert {r.item: r.affectedRows for r in delete_per_item(df, some, where).outcome.collect()} == {1: 1, 2: 0}


def test_the_table_is_read_once_for_many_items(spark, tmp_path):
    spark.range(20_000).select(F.col("id"), (F.col("id") * 7919 % 1_000_003).alias("v")).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    items = spark.range(100_000).select(
        F.col("id").alias("item"), (F.col("id") * 10).alias("low"), (F.col("id") * 10 + 15).alias("high")
    )
    found, _ = select_per_item(df, Items(items), TEMPLATES[2])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("[id#") > 0 and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert plan.count("ReadSchema: struct<id:bigint,v:bigint>") == 1
    expected = df.where("v >= 0").agg(F.sum(F.expr("least(v div 10, 99999) - greatest(ceil((v - 14) / 10.0), 0) + 1"))).first()[0]
    within = df.where("v < 1000015").agg(F.sum(F.expr("greatest(least(v div 10, 99999) - greatest(cast(ceil((v - 14) / 10.0) as long), 0) + 1, 0)"))).first()[0]
    assert expected is not None and found.count() == within


@pytest.mark.parametrize("where", TEMPLATES[:3])
@pytest.mark.parametrize("direction", ["ASC", "DESC"])
def test_first_rows_of_each_range(spark, narrow, monkeypatch, where, direction):
    """The first rows by the compared column are taken by their places, without all pairs."""
    monkeypatch.setattr(bands, "select_by_bands", None)
    rng = random.Random(len(where))
    values = [-0.0, 0.0, *[rng.randint(-20, 20) / 2 for _ in range(20)]]
    rows, items = cases(rng, 200, 60, values)
    df = spark.createDataFrame(rows, "id int, v double, s string")
    batch = Items(spark.createDataFrame(items, "item long, low double, high double, s string"))
    found, _ = select_per_item(df, batch, where, sort=[SortRule("v", direction), SortRule("id")], limit=3)
    sign = -1 if direction == "DESC" else 1
    expected = []
    for item in items:
        own = sorted((sign * row[1], row[0]) for row in rows if holds(row, item, where))
        expected += [(item[0], row_id) for _, row_id in own[:3]]
    assert sorted((r.item, r.id) for r in found.collect()) == sorted(expected)


def test_numbers_are_placed_without_the_edges_in_every_row(spark, narrow):
    df = spark.range(300).select("id", (F.col("id") % 50).cast("double").alias("v"))
    items = Items(spark.range(200).select(F.col("id").alias("item"), (F.col("id") % 40).alias("low")))
    where = [Condition("v", "greaterThan", FromItem("low"))]
    found, _ = select_per_item(df, items, where)
    plan = found._jdf.queryExecution().analyzed().toString()
    assert "__edges" not in plan
    assert found.count() == sum(i % 50 > k % 40 for i in range(300) for k in range(200))


def test_other_types_are_placed_in_the_array_of_edges(spark, narrow):
    values = [Decimal(k * 7 % 31) / 10 for k in range(60)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v decimal(9,2)")
    batch = Items(spark.createDataFrame([(k, Decimal(k) / 10) for k in range(30)], "item long, low decimal(9,2)"))
    found, _ = select_per_item(df, batch, [Condition("v", "greaterThan", FromItem("low"))])
    assert found.count() == sum(v > Decimal(k) / 10 for v in values for k in range(30))


@pytest.mark.parametrize("where", TEMPLATES)
def test_reads_meet_blocks_in_parts_and_chunks(spark, monkeypatch, where):
    """Values that many rows share fill several blocks, and the items of a part are dealt over chunks."""
    for name, size in (("ROWS_PER_BLOCK", 4), ("BLOCKS_PER_PART", 3), ("ROWS_PER_CHUNK", 100)):
        monkeypatch.setattr(bands, name, size)
    monkeypatch.setattr(bands, "fits_broadcast", lambda df: False)
    rng = random.Random(len(where))
    rows, items = cases(rng, 300, 60, [0, 0, 0, 0, 5, 5, *range(-20, 20)])
    df = spark.createDataFrame(rows, "id int, v int, s string")
    batch = Items(spark.createDataFrame(items, "item long, low int, high int, s string"))
    found, _ = select_per_item(df, batch, where)
    expected = [(item[0], *row) for item in items for row in rows if holds(row, item, where)]
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, expected))


def test_rows_are_not_multiplied_before_they_meet_items(spark, monkeypatch):
    """A row is sent once for its block, however many items cover it, not once for each level of a tree."""
    monkeypatch.setattr(bands, "fits_broadcast", lambda df: False)
    df = spark.range(5_000).select("id", (F.col("id") * 7 % 5_000).alias("v"))
    items = spark.range(3_000).select(F.col("id").alias("item"), (F.col("id") - 100).alias("low"))
    found, _ = select_per_item(df, Items(items), [Condition("v", "greaterThan", FromItem("low"))])
    assert found.count() == sum(min(5_000, 4_999 - (i - 100)) for i in range(3_000))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 3  # items over parts, blocks over chunks, the rows of a block


def test_shuffles_of_reads_do_not_grow_with_covered_rows(spark, monkeypatch):
    """What is sent is items and rows, however many rows an item covers: a copy of an item per part."""
    monkeypatch.setattr(bands, "fits_broadcast", lambda df: False)
    df = spark.range(20_000).select("id", (F.col("id") * 7 % 20_000).cast("double").alias("v"))
    items = spark.range(400).select(F.col("id").alias("item"), F.lit(0.0).alias("low"), F.lit(1e6).alias("high"))
    sent = []
    real = bands.Blocks.chunks
    monkeypatch.setattr(bands.Blocks, "chunks", lambda self, copies: sent.append(copies.count()) or real(self, copies))
    found, _ = select_per_item(df, Items(items), TEMPLATES[2])
    assert sent == [400] and found.count() == 400 * 20_000
