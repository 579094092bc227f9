"""Requests over several tables, sets of items with unusual indexes, and inserts of unknown keys only."""

from __future__ import annotations

import random

import pytest

from tablesmith import (
    Condition,
    DeleteRequest,
    FromItem,
    Items,
    TableOperationError,
    UpdateRequest,
    items_from_objects,
)

PARTS = "P INT, K INT, V STRING"


@pytest.fixture
def parted(spark, operations, schema):
    operations.store.create(schema, "PARTED", PARTS, partitioned_by=["P"])
    spark.sql(f"INSERT INTO {schema}.PARTED (P, K, V) VALUES (1, 1, 'a'), (1, 2, 'b'), (2, 1, 'c')")
    return "PARTED"


def content(spark, schema, table):
    return sorted(spark.table(f"{schema}.{table}").select("P", "K", "V").collect(), key=str)


def test_unknown_keys_are_added_and_nothing_else_changes(spark, operations, schema, parted):
    items = items_from_objects(spark, [{"P": 1, "K": 1}, {"P": 3, "K": 9}])
    outcome = operations.upsert(schema, parted, items, keys=["P", "K"]).first()
    assert outcome.affectedRows == 1
    assert content(spark, schema, parted) == sorted([(1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (3, 9, None)], key=str)


def test_known_keys_stay_where_the_partition_is_not_mapped(spark, operations, schema, parted):
    items = items_from_objects(spark, [{"K": 2}, {"K": 7}])
    assert operations.upsert(schema, parted, items, keys=["K"]).first().affectedRows == 1
    assert content(spark, schema, parted) == sorted([(1, 1, "a"), (1, 2, "b"), (2, 1, "c"), (None, 7, None)], key=str)


@pytest.mark.parametrize("seed", range(3))
def test_random_upserts_of_a_partitioned_table(spark, operations, schema, parted, seed):
    draw = random.Random(seed)
    known = {(1, 1): "a", (1, 2): "b", (2, 1): "c"}
    for only_keys in (True, False, True):
        keys = {(draw.randint(1, 4), draw.randint(1, 3)) for _ in range(5)}
        objects = [{"P": p, "K": k} | ({} if only_keys else {"V": f"n{p}{k}"}) for p, k in sorted(keys)]
        new = {key: None if only_keys else f"n{key[0]}{key[1]}" for key in keys}
        operations.upsert(schema, parted, items_from_objects(spark, objects), keys=["P", "K"])
        known = {**new, **known} if only_keys else {**known, **new}
        assert content(spark, schema, parted) == sorted([(*key, v) for key, v in known.items()], key=str)


@pytest.mark.parametrize("continue_on_fail", [False, True])
def test_requests_run_in_order_over_tables(spark, operations, schema, continue_on_fail):
    for name in ("A", "B"):
        operations.store.create(schema, name, "ID INT, V INT")
        spark.sql(f"INSERT INTO {schema}.{name} VALUES (1, 0)")
    one = [Condition("ID", "equals", 1)]
    requests = [
        UpdateRequest(schema, "A", {"V": 1}, one),
        UpdateRequest(schema, "B", {"V": 1}, one),
        UpdateRequest(schema, "A", {"NO_SUCH": 1}, one),
        UpdateRequest(schema, "B", {"V": 2}, one),
    ]
    if continue_on_fail:
        found = operations.update(requests, continue_on_fail=True).orderBy("item").collect()
        assert [r.error is None for r in found] == [True, True, False, True]
    else:
        with pytest.raises(TableOperationError) as caught:
            operations.update(requests)
        assert caught.value.item == 2
    assert spark.table(f"{schema}.A").first().V == 1
    assert spark.table(f"{schema}.B").first().V == (2 if continue_on_fail else 1)


@pytest.mark.parametrize("indexes", [[-1, 0], [0, 400_000], [-(1 << 40), 1 << 33, 1 << 60]])
def test_any_item_index_is_answered(spark, operations, schema, items_table, indexes):
    items = Items(spark.createDataFrame([(i, 1000) for i in indexes], "item bigint, low int"))
    rows, _ = operations.select_items(schema, items_table, items, [Condition("ALTITUDE", "greaterThan", FromItem("low"))])
    assert sorted(r.item for r in rows.collect()) == sorted(indexes * 2)


def test_item_values_take_the_type_of_the_column(spark, operations, schema):
    operations.store.create(schema, "BIG", "ID BIGINT")
    spark.sql(f"INSERT INTO {schema}.BIG VALUES (9007199254740992), (9007199254740993)")
    where = [Condition("ID", "equals", FromItem("v"))]
    items = Items(spark.createDataFrame([(0, 9007199254740992.0), (1, 0.5), (2, 1e300)], "item bigint, v double"))
    rows, errors = operations.select_items(schema, "BIG", items, where)
    assert [(r.item, r.ID) for r in rows.collect()] == [(0, 9007199254740992)] and errors.isEmpty()
    text = items_from_objects(spark, [{"v": "9007199254740993"}, {"v": "1.5"}])
    rows, errors = operations.select_items(schema, "BIG", text, where)
    assert [(r.item, r.ID) for r in rows.collect()] == [(0, 9007199254740993)] and errors.isEmpty()
    assert "cast(ID" not in rows._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("value", [float("inf"), float("nan"), float("-inf")])
def test_values_that_are_not_finite_are_refused(spark, operations, schema, items_table, value):
    items = Items(spark.createDataFrame([(0, value)], "item bigint, v double"))
    where = [Condition("ID", "lessThan", FromItem("v"))]
    found = operations.delete_items(schema, items_table, items, where, continue_on_fail=True).first()
    assert found.error and spark.table(f"{schema}.{items_table}").count() == 3


def test_a_late_failure_in_one_table_keeps_what_was_before(spark, operations, schema, items_table):
    requests = [
        DeleteRequest(schema, items_table, [Condition("ID", "equals", 1)]),
        DeleteRequest(schema, items_table, []),
    ]
    with pytest.raises(TableOperationError):
        operations.delete(requests)
    assert sorted(r.ID for r in spark.table(f"{schema}.{items_table}").collect()) == [2, 3]
