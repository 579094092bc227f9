"""Plans that must hold on large tables: hot keys are split, nothing is paired with everything."""

import __spark_entry__ as entry_points
import pytest
from pyspark.sql import functions as F

from tablesmith import Condition, FromItem, Items, SortRule
from tablesmith.operators import delete, select, update, upsert
from tablesmith.sources import scratch
from tablesmith.sources.items import ITEM

FOLDER = "/root/testdata/sf0.01"
SMALL_SPLITS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.shuffle.partitions": "32",
}
BY_KEY = [Condition("l_orderkey", "equals", FromItem("k"))]


@pytest.fixture
def large(spark, monkeypatch):
    """Nothing counts as small, and partitions of a few kilobytes count as skewed."""
    for module in (upsert, update, delete, select):
        monkeypatch.setattr(module, "fits_broadcast", lambda df: False)
    before = {name: spark.conf.get(name, None) for name in SMALL_SPLITS}
    for name, value in SMALL_SPLITS.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture
def lines(spark):
    """A third of all rows has one order key."""
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet").repartition(16)
    hot = F.when(F.col("l_partkey") % 3 == 0, F.lit(7).cast("bigint"))
    return lines.withColumn("l_orderkey", hot.otherwise(F.col("l_orderkey")))


@pytest.fixture
def orders(spark):
    return spark.read.parquet(f"{FOLDER}/orders.parquet")


def order_items(orders):
    return Items(
        orders.select(F.col("o_orderkey").alias("item"), F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("v"))
    )


def final_plan(df):
    """The plan after Spark has looked at the shuffled sizes."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def test_hot_table_keys_are_split(large, lines, orders):
    source = orders.select(
        F.col("o_orderkey").alias(ITEM), F.col("o_orderkey").alias("l_orderkey"), F.lit(99.0).alias("l_quantity")
    )
    assert "skew=true" in final_plan(upsert.upsert_rows(lines, source, ["l_orderkey"]).updated)
    change = update.update_per_item(lines, order_items(orders), BY_KEY, sets={"l_quantity": FromItem("v")})
    assert "skew=true" in final_plan(change.image)
    change = delete.delete_per_item(
        lines, order_items(orders), [*BY_KEY, Condition("l_quantity", "lessThan", 10)]
    )
    assert "skew=true" in final_plan(change.image)


def test_hot_items_are_split(large, lines, orders):
    many = Items(lines.select(F.monotonically_increasing_id().alias("item"), F.col("l_orderkey").alias("k")))
    by_key = [Condition("o_orderkey", "equals", FromItem("k"))]
    rows, _ = select.select_per_item(orders, many, by_key, sort=[SortRule("o_totalprice")], limit=2)
    assert "skew=true" in final_plan(rows)
    change = update.update_per_item(orders, many, by_key, sets={"o_orderstatus": "X"})
    assert "skew=true" in final_plan(change.outcome)


def test_large_and_small_plans_agree(spark, large, monkeypatch, lines, orders):
    def results():
        items = order_items(orders.where("o_orderkey < 500"))
        changed = update.update_per_item(lines, items, BY_KEY, sets={"l_quantity": FromItem("v")})
        removed = delete.delete_per_item(lines, items, BY_KEY)
        chosen, _ = select.select_per_item(
            orders, items, [Condition("o_custkey", "equals", FromItem("k"))], sort=[SortRule("o_orderkey")], limit=2
        )
        frames = [changed.image, changed.outcome, removed.image, removed.outcome, chosen]
        # Order-free digests: number of rows and sum of row hashes.
        return [
            tuple(df.agg(F.count("*"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first())
            for df in frames
        ]

    shuffled = results()
    for module in (update, delete, select):
        monkeypatch.setattr(module, "fits_broadcast", lambda df: True)
    assert results() == shuffled


def test_size_check_before_a_broadcast(spark, monkeypatch):
    assert scratch.fits_broadcast(spark.range(1000))
    assert not scratch.fits_broadcast(spark.range(scratch.BROADCAST_ROWS + 1))
    wide = spark.range(100).select(F.repeat(F.lit("x"), 1_000_000).alias("t"))
    assert not scratch.fits_broadcast(wide)
    monkeypatch.setattr(scratch, "BROADCAST_ROWS", 10)
    assert scratch.fits_broadcast(spark.range(10))
    assert not scratch.fits_broadcast(spark.range(11))


@pytest.mark.parametrize("name", sorted(entry_points.queries()))
def test_no_query_pairs_everything(spark, name):
    df = entry_points.queries()[name](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan


def test_newest_month_reaches_the_scan(spark):
    df = entry_points.entry(spark)
    df.collect()
    assert "GreaterThanOrEqual(l_shipdate,ScalarSubquery" in df._jdf.queryExecution().toString()


def test_the_range_of_all_items_reaches_the_scan(spark):
    df = entry_points.queries()["select_per_item_range"](spark, FOLDER)
    df.collect()
    assert "GreaterThanOrEqual(o_totalprice,ScalarSubquery" in df._jdf.queryExecution().toString()


def test_a_limit_per_item_is_applied_before_the_shuffle(spark):
    df = entry_points.queries()["select_per_item_topn"](spark, FOLDER)
    assert "WindowGroupLimit" in df._jdf.queryExecution().toString()
