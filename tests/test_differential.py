"""Random items: one set-based plan against the same statements run one by one elsewhere."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tablesmith import Condition, FromItem, Items, index_items, items_from_objects
from tablesmith.operators import matching
from tablesmith.operators.delete import delete_per_item
from tablesmith.operators.select import select_per_item
from tablesmith.operators.update import update_per_item
from tablesmith.operators.upsert import upsert_rows
from tablesmith.sources.items import ITEM

SYMBOLS = {
    "equals": "=",
    "notEquals": "!=",
    "lessThan": "<",
    "lessThanOrEqual": "<=",
    "greaterThan": ">",
    "greaterThanOrEqual": ">=",
}


def target_rows(rng, n=60):
    return [
        (i, rng.choice([None, *range(6)]), rng.choice([None, *range(6)]), rng.choice(["x", "y", None]))
        for i in range(n)
    ]


@pytest.fixture
def duck():
    connection = duckdb.connect()
    connection.execute("CREATE TABLE t (id INT, a INT, b INT, s VARCHAR)")
    return connection


def load(duck, rows):
    duck.execute("DELETE FROM t")
    duck.executemany("INSERT INTO t VALUES (?, ?, ?, ?)", rows)
    return rows


def random_template(rng):
    names = rng.sample(["a", "b"], rng.randint(1, 2))
    conditions = [Condition(n, rng.choice(list(SYMBOLS)), FromItem(f"w_{n}")) for n in names]
    if rng.random() < 0.4:
        conditions.append(Condition("id", "lessThan", rng.randint(10, 60)))
    return conditions, rng.choice(["AND", "OR"])


def where_sql(conditions, combine, item):
    parts, values = [], []
    for condition in conditions:
        parts.append(f"{condition.column} {SYMBOLS[condition.operator]} ?")
        value = condition.value
        values.append(item[value.name] if isinstance(value, FromItem) else value)
    return f" {combine} ".join(parts), values


def random_items(rng, n):
    return [
        {"w_a": rng.choice([None, *range(6)]), "w_b": rng.choice([None, *range(6)]), "v": rng.choice([None, *range(6)]), "u": rng.choice(["p", "q", None])}
        for _ in range(n)
    ]


def items_frame(spark, items):
    rows = [(i, x["w_a"], x["w_b"], x["v"], x["u"]) for i, x in enumerate(items)]
    return Items(spark.createDataFrame(rows, "item int, w_a int, w_b int, v int, u string"))


@pytest.mark.parametrize("seed", range(8))
def test_per_item_operations(spark, duck, seed, monkeypatch):
    rng = random.Random(seed)
    if seed % 2:
        monkeypatch.setattr(matching, "ITEMS_PER_SLICE", 3)
    rows = target_rows(rng)
    target = spark.createDataFrame(rows, "id int, a int, b int, s string")
    items = random_items(rng, rng.randint(1, 9))
    batch = items_frame(spark, items)
    conditions, combine = random_template(rng)

    load(duck, rows)
    expected = []
    for number, item in enumerate(items):
        where, values = where_sql(conditions, combine, item)
        expected += [(number, *row) for row in duck.execute(f"SELECT * FROM t WHERE {where}", values).fetchall()]
    found, _ = select_per_item(target, batch, conditions, combine)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(expected, key=repr)

    counts = []
    for item in items:
        where, values = where_sql(conditions, combine, item)
        counts.append(duck.execute(f"DELETE FROM t WHERE {where}", values).fetchall()[0][0])
    change = delete_per_item(target, batch, conditions, combine)
    assert [r.affectedRows for r in change.outcome.orderBy("item").collect()] == counts
    left = duck.execute("SELECT * FROM t ORDER BY id").fetchall()
    assert [tuple(r) for r in change.image.orderBy("id").collect()] == left

    load(duck, rows)
    counts = []
    column = rng.choice(["a", "b", "s"])
    source = "u" if column == "s" else "v"
    for item in items:
        where, values = where_sql(conditions, combine, item)
        done = duck.execute(f"UPDATE t SET {column} = ? WHERE {where}", [item[source], *values])
        counts.append(done.fetchall()[0][0])
    change = update_per_item(target, batch, conditions, combine, {column: FromItem(source)})
    assert [r.affectedRows for r in change.outcome.orderBy("item").collect()] == counts
    left = duck.execute("SELECT * FROM t ORDER BY id").fetchall()
    assert [tuple(r) for r in change.image.orderBy("id").collect()] == left


@pytest.mark.parametrize("seed", range(3))
def test_updates_with_varying_columns(spark, duck, seed):
    """Items that name different columns, by key and with the key among the set columns."""
    rng = random.Random(seed)
    rows = load(duck, target_rows(rng, 30))
    target = spark.createDataFrame(rows, "id int, a int, b int, s string")
    objects = []
    for _ in range(20):
        item = {"id": rng.randint(0, 35)}
        for name in rng.sample(["a", "b", "s"], rng.randint(1, 3)):
            item[name] = rng.choice([None, "7"]) if name != "s" else rng.choice([None, "new"])
        objects.append(item)
    counts = []
    for item in objects:
        sets = ", ".join(f"{name} = ?" for name in item)
        done = duck.execute(f"UPDATE t SET {sets} WHERE id = ?", [*item.values(), item["id"]])
        counts.append(done.fetchall()[0][0])
    change = update_per_item(
        target, items_from_objects(spark, objects), [Condition("id", "equals", FromItem("id"))]
    )
    assert [r.affectedRows for r in change.outcome.orderBy("item").collect()] == counts
    left = duck.execute("SELECT * FROM t ORDER BY id").fetchall()
    assert [tuple(r) for r in change.image.orderBy("id").collect()] == left


@pytest.mark.parametrize("seed", range(4))
def test_upserts(spark, duck, seed, monkeypatch):
    from tablesmith.operators import upsert as module

    if seed % 2:
        monkeypatch.setattr(module, "fits_broadcast", lambda df: False)
    rng = random.Random(seed)
    rows = load(duck, target_rows(rng))
    target = spark.createDataFrame(rows, "id int, a int, b int, s string")
    pairs = rng.sample([(a, b) for a in range(8) for b in range(8)], 20)
    source = [(i, a, b, rng.choice(["new", None])) for i, (a, b) in enumerate(pairs)]
    updated = inserted = 0
    for _, a, b, s in source:
        n = duck.execute("UPDATE t SET s = ? WHERE a = ? AND b = ?", [s, a, b]).fetchall()[0][0]
        updated += n
        if n == 0:
            duck.execute("INSERT INTO t VALUES (NULL, ?, ?, ?)", [a, b, s])
            inserted += 1
    plan = upsert_rows(target, spark.createDataFrame(source, f"{ITEM} bigint, a int, b int, s string"), ["a", "b"])
    expected = duck.execute("SELECT * FROM t").fetchall()
    assert sorted(map(tuple, plan.image.collect()), key=repr) == sorted(expected, key=repr)
    assert tuple(plan.counts.first()) == (updated + inserted, updated, inserted)


def test_index_is_dense_and_ordered(spark):
    df = spark.range(5000, numPartitions=7).select((F.hash("id") % 500).alias("k"), "id")
    indexed = index_items(df, ["k", "id"])
    rows = indexed.orderBy("item").collect()
    assert [r.item for r in rows] == list(range(5000))
    assert [(r.k, r.id) for r in rows] == sorted((r.k, r.id) for r in rows)
