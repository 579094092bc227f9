"""Every registered query against its SQL, on the smallest tables."""

import __spark_entry__ as entry_points
import pytest
from compare import connect, difference

from tablesmith.plans import checked

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = checked.queries(), checked.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    # The driver's session keeps Spark's own name resolution.
    df = QUERIES[name](spark, FOLDER)
    assert difference(df, duck, SQL[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark, duck):
    # The newest month of the smallest tables has fewer than ten groups.
    df = entry_points.entry(spark)
    assert difference(df, duck, SQL["report_latest_month_top10"]) is None
    assert df.count() > 0


def test_every_purchase_is_an_item(spark):
    folder = "/root/testdata/sf0.01"
    found = QUERIES["select_per_item_sparse_index_all"](spark, folder)
    top = checked.table(spark, folder, "part").agg({"p_retailprice": "max"}).first()[0]
    purchases = checked.table(spark, folder, "events").where(f"event_type = 'purchase' AND {top} > 800 + 100 * value")
    assert found.select("item").distinct().count() == purchases.count() > 0
    assert difference(found, connect(folder), SQL["select_per_item_sparse_index_all"]) is None
