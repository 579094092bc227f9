"""Every operation over the test tables, next to the SQL that must give the same rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.guard import lexical_verdicts
from ..functions.ordering import SortRule
from ..functions.predicates import Condition, FromItem
from ..functions.text import cut_middle, factorial, fibonacci, weighted_length
from ..operators.delete import DeleteStatement, delete_per_item, delete_rows
from ..operators.insert import batch_rows, insert_image, mapping_rows
from ..operators.query import merge_statement, statement_change
from ..operators.select import concatenated, result_cap, select_per_item, select_rows, tagged, unique_names
from ..operators.update import UpdateStatement, update_per_item, update_rows
from ..operators.upsert import (
    check_source,
    duplicate_keys,
    duplicate_rows,
    null_keys,
    upsert_rows,
)
from ..sources.items import ITEM, Items, index_items
from .reports import daily_revenue, latest_month_report, positive_days

Loader = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Loader] = {}
_SQL: dict[str, str] = {}


def queries() -> dict[str, Loader]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def checked(name: str, sql: str | None):
    """Register a query, together with the SQL it is compared with."""

    def register(function: Loader) -> Loader:
        _QUERIES[name] = function
        if sql is not None:
            _SQL[name] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# -- structured reads ------------------------------------------------------------------------------


@checked(
    "select_where_or_sort_limit",
    """SELECT * FROM customer WHERE c_acctbal > 9000 OR c_name LIKE '%77%'
       ORDER BY c_acctbal DESC NULLS LAST, c_custkey ASC NULLS LAST LIMIT 50""",
)
def _select(spark, folder):
    return select_rows(
        table(spark, folder, "customer"),
        [Condition("c_acctbal", "greaterThan", "9000"), Condition("c_name", "like", "%77%")],
        "OR",
        [SortRule("c_acctbal", "DESC"), SortRule("c_custkey")],
        "50",
    )


def _filter(name: str, source: str, condition: Condition, where: str) -> None:
    @checked(f"filter_{name}", f"SELECT * FROM {source} WHERE {where}")
    def _run(spark, folder):
        return select_rows(table(spark, folder, source), [condition])


_filter("equals", "orders", Condition("o_orderstatus", "equals", "F"), "o_orderstatus = 'F'")
_filter(
    "not_equals", "lineitem", Condition("l_returnflag", "notEquals", "R"), "l_returnflag != 'R'"
)
_filter("less_than", "lineitem", Condition("l_quantity", "lessThan", "10"), "l_quantity < 10")
_filter(
    "less_than_or_equal", "part", Condition("p_size", "lessThanOrEqual", "15.5"), "p_size <= 15.5"
)
_filter(
    "greater_than",
    "orders",
    Condition("o_totalprice", "greaterThan", "250000.5"),
    "o_totalprice > 250000.5",
)
_filter(
    "greater_than_or_equal",
    "orders",
    Condition("o_orderdate", "greaterThanOrEqual", dt.datetime(1998, 6, 1)),
    "o_orderdate >= TIMESTAMP '1998-06-01 00:00:00'",
)
_filter("like", "customer", Condition("c_name", "like", "%7%1"), "c_name LIKE '%7%1'")
_filter(
    "like_on_number", "orders", Condition("o_orderkey", "like", "1%5"), "CAST(o_orderkey AS VARCHAR) LIKE '1%5'"
)
_filter("not_like", "part", Condition("p_name", "notLike", "small%"), "p_name NOT LIKE 'small%'")
_filter(
    "regexp_like",
    "documents",
    Condition("text", "regexpLike", "[0-9]{3}[^0-9]"),
    "regexp_matches(text, '[0-9]{3}[^0-9]')",
)
_filter(
    "not_regexp_like",
    "documents",
    Condition("text", "notRegexpLike", "[A-Z][a-z]+ing"),
    "NOT regexp_matches(text, '[A-Z][a-z]+ing')",
)

_GRADED = "SELECT d.doc_id, d.lang, l.quality FROM documents d LEFT JOIN labels l USING (doc_id)"


def _graded(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "lang")
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    return documents.join(labels, "doc_id", "left")


@checked("filter_is_null", f"SELECT doc_id, lang FROM ({_GRADED}) WHERE quality IS NULL")
def _is_null(spark, folder):
    rows = select_rows(_graded(spark, folder), [Condition("quality", "isNull", "ignored")])
    return rows.select("doc_id", "lang")


@checked("filter_is_not_null", f"SELECT * FROM ({_GRADED}) WHERE quality IS NOT NULL")
def _is_not_null(spark, folder):
    return select_rows(_graded(spark, folder), [Condition("quality", "isNotNull")])


@checked(
    "filter_null_never_matches",
    f"SELECT * FROM ({_GRADED}) WHERE quality != 1 AND lang = 'fr'",
)
def _three_valued(spark, folder):
    return select_rows(
        _graded(spark, folder),
        [Condition("quality", "notEquals", "1"), Condition("lang", "equals", "fr")],
    )


@checked(
    "select_requests",
    """SELECT 0 AS item, * FROM (SELECT * FROM supplier WHERE s_acctbal < 0)
       UNION ALL
       SELECT 1 AS item, * FROM
         (SELECT * FROM supplier ORDER BY s_acctbal DESC NULLS LAST, s_suppkey LIMIT 7)
       UNION ALL
       SELECT 2 AS item, * FROM (SELECT * FROM supplier WHERE s_nationkey = 3 OR s_nationkey = 4)""",
)
def _requests(spark, folder):
    supplier = table(spark, folder, "supplier")
    top = [SortRule("s_acctbal", "DESC"), SortRule("s_suppkey")]
    either = [Condition("s_nationkey", "equals", "3"), Condition("s_nationkey", "equals", 4)]
    reads = [
        select_rows(supplier, [Condition("s_acctbal", "lessThan", 0)]),
        select_rows(supplier, sort=top, limit=7),
        select_rows(supplier, either, "OR"),
    ]
    return concatenated([tagged(rows, item) for item, rows in enumerate(reads)])


@checked(
    "select_per_item",
    """SELECT e.event_id AS item, c.* FROM events e JOIN customer c ON c.c_custkey = e.user_id
       WHERE c.c_acctbal > 0""",
)
def _per_item(spark, folder):
    events = table(spark, folder, "events").select(F.col("event_id").alias("item"), "user_id")
    rows, _ = select_per_item(
        table(spark, folder, "customer"),
        Items(events),
        [Condition("c_custkey", "equals", FromItem("user_id")), Condition("c_acctbal", "greaterThan", 0)],
    )
    return rows


@checked(
    "select_per_item_topn",
    """SELECT item, o_orderkey, o_custkey, o_totalprice FROM (
         SELECT c.c_custkey AS item, o.*, row_number() OVER (PARTITION BY c.c_custkey
                ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS rn
         FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey) WHERE rn <= 3""",
)
def _per_item_topn(spark, folder):
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("item"))
    items = Items(customers.withColumn("customer", F.col("item")))
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    rows, _ = select_per_item(
        orders,
        items,
        [Condition("o_custkey", "equals", FromItem("customer"))],
        sort=[SortRule("o_totalprice", "DESC"), SortRule("o_orderkey")],
        limit=3,
    )
    return rows


def _nation_items(spark, folder) -> DataFrame:
    return table(spark, folder, "nation").select(F.col("n_nationkey").alias("item"), "n_name")


@checked(
    "select_per_item_range",
    """SELECT n.n_nationkey AS item, o.o_orderkey, o.o_totalprice FROM nation n JOIN orders o
       ON o.o_totalprice > 450000 + 1000 * n.n_nationkey
       AND CAST(o.o_orderkey AS VARCHAR) LIKE '%' || n.n_nationkey""",
)
def _per_item_range(spark, folder):
    items = _nation_items(spark, folder).select(
        "item",
        (450000 + 1000 * F.col("item")).alias("floor"),
        F.concat(F.lit("%"), F.col("item")).alias("pattern"),
    )
    rows, _ = select_per_item(
        table(spark, folder, "orders").select("o_orderkey", "o_totalprice"),
        Items(items),
        [
            Condition("o_totalprice", "greaterThan", FromItem("floor")),
            Condition("o_orderkey", "like", FromItem("pattern")),
        ],
    )
    return rows


@checked(
    "select_per_item_between",
    """SELECT e.event_id AS item, o.o_orderkey, o.o_totalprice FROM events e JOIN orders o
       ON o.o_totalprice >= 1000 * e.value AND o.o_totalprice < 1000 * e.value + 100""",
)
def _between(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    rows, _ = select_per_item(orders, _price_bands(spark, folder, 100), _in_band("o_totalprice"))
    return rows


def _price_bands(spark, folder, width: int) -> Items:
    low = 1000 * F.col("value")
    events = table(spark, folder, "events").select(F.col("event_id").alias("item"), low.alias("low"))
    return Items(events.withColumn("high", F.col("low") + width))


def _in_band(column: str) -> list[Condition]:
    return [Condition(column, "greaterThanOrEqual", FromItem("low")), Condition(column, "lessThan", FromItem("high"))]


@checked(
    "select_per_item_patterns",
    """SELECT p.p_partkey AS item, o.o_orderkey FROM part p JOIN orders o
       ON CAST(o.o_orderkey AS VARCHAR) LIKE '%' || CAST(p.p_partkey AS VARCHAR) || '_'""",
)
def _patterns(spark, folder):
    key = F.col("p_partkey")
    items = table(spark, folder, "part").select(
        key.alias("item"), F.concat(F.lit("%"), key.cast("string"), F.lit("_")).alias("pattern")
    )
    where = [Condition("o_orderkey", "like", FromItem("pattern"))]
    rows, _ = select_per_item(table(spark, folder, "orders").select("o_orderkey"), Items(items), where)
    return rows


_BY_PATTERNS_SQL = """(SELECT o_orderkey, min(p_partkey) AS item FROM orders LEFT JOIN part
  ON CAST(o_orderkey AS VARCHAR) LIKE '%' || CAST(p_partkey AS VARCHAR) || '0'
  OR CAST(o_orderkey AS VARCHAR) LIKE '%' || CAST(p_partkey AS VARCHAR) || '5' GROUP BY 1)"""


def _delete_by_patterns(spark, folder):
    key = F.col("p_partkey")
    items = table(spark, folder, "part").select(
        key.alias("item"), F.concat(key.cast("string"), F.lit("[05]$")).alias("pattern")
    )
    where = [Condition("o_orderkey", "regexpLike", FromItem("pattern"))]
    return delete_per_item(table(spark, folder, "orders").select("o_orderkey"), Items(items), where)


@checked("delete_per_item_patterns", f"SELECT o_orderkey FROM {_BY_PATTERNS_SQL} WHERE item IS NULL")
def _delete_patterns(spark, folder):
    return _delete_by_patterns(spark, folder).image


@checked(
    "delete_per_item_patterns_counts",
    f"""SELECT p_partkey AS item, count(o_orderkey) AS "affectedRows" FROM part
        LEFT JOIN {_BY_PATTERNS_SQL} ON item = p_partkey GROUP BY 1""",
)
def _delete_patterns_counts(spark, folder):
    return _delete_by_patterns(spark, folder).outcome.select("item", "affectedRows")


@checked(
    "select_per_item_key_and_range",
    """SELECT e.event_id AS item, o.o_orderkey, o.o_totalprice FROM events e JOIN orders o
       ON o.o_custkey = e.user_id AND o.o_totalprice > 1000 * e.value""",
)
def _key_and_range(spark, folder):
    events = table(spark, folder, "events").select(
        F.col("event_id").alias("item"), "user_id", (1000 * F.col("value")).alias("floor")
    )
    where = [Condition("o_custkey", "equals", FromItem("user_id")), Condition("o_totalprice", "greaterThan", FromItem("floor"))]
    rows, _ = select_per_item(table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), Items(events), where)
    return rows.drop("o_custkey")


@checked(
    "select_per_item_between_topn",
    """SELECT item, o_orderkey, o_totalprice FROM (
         SELECT e.event_id AS item, o.o_orderkey, o.o_totalprice, row_number() OVER (PARTITION BY e.event_id
                ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS rn
         FROM events e JOIN orders o ON o.o_totalprice >= 1000 * e.value AND o.o_totalprice < 1000 * e.value + 400
           AND o.o_orderstatus = 'F') WHERE rn <= 2""",
)
def _between_topn(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    rows, _ = select_per_item(
        orders,
        _price_bands(spark, folder, 400),
        [*_in_band("o_totalprice"), Condition("o_orderstatus", "equals", "F")],
        sort=[SortRule("o_totalprice", "DESC"), SortRule("o_orderkey")],
        limit=2,
    )
    return rows.drop("o_orderstatus")


@checked(
    "select_per_item_sparse_index_all",
    """SELECT 1000000000 * e.event_id - 5 AS item, p.p_partkey FROM events e JOIN part p
       ON p.p_retailprice > 800 + 100 * e.value AND e.event_type = 'purchase'""",
)
def _sparse_index_all(spark, folder):
    return _parts_above(spark, folder, "event_type = 'purchase'")


def _parts_above(spark, folder, events: str) -> DataFrame:
    items = table(spark, folder, "events").where(events).select(
        (F.lit(1_000_000_000) * F.col("event_id") - 5).alias("item"), (800 + 100 * F.col("value")).alias("floor")
    )
    parts = table(spark, folder, "part").select("p_partkey", "p_retailprice")
    rows, _ = select_per_item(parts, Items(items), [Condition("p_retailprice", "greaterThan", FromItem("floor"))])
    return rows.drop("p_retailprice")


@checked(
    "result_cap_of_sorted_rows",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1000",
)
def _cap(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    rows = select_rows(orders, sort=[SortRule("o_totalprice", "DESC"), SortRule("o_orderkey")])
    return result_cap(rows, 1000)


@checked(
    "duplicate_names_last_wins",
    """SELECT s.s_suppkey AS id, s.s_name AS name, n.n_nationkey AS key
       FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey""",
)
def _last_wins(spark, folder):
    supplier = table(spark, folder, "supplier")
    nation = table(spark, folder, "nation")
    joined = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("name"),
        F.col("s_suppkey").alias("id"),
        F.col("s_nationkey").alias("key"),
        F.col("s_name").alias("name"),
        F.col("n_nationkey").alias("key"),
    )
    return unique_names(joined).select("id", "name", "key")


# -- items -----------------------------------------------------------------------------------------


@checked(
    "items_indexed",
    """SELECT row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS item, o_orderkey
       FROM orders""",
)
def _indexed(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return index_items(orders, ["o_totalprice", "o_orderkey"]).select("item", "o_orderkey")


# -- inserts ---------------------------------------------------------------------------------------


@checked(
    "insert_auto_map",
    """SELECT p_partkey, p_name, p_brand, p_size, p_retailprice FROM part
       UNION ALL
       SELECT 1000000 + event_id, event_type, NULL,
              CASE WHEN event_type = 'view' THEN NULL ELSE user_id % 50 END, value
       FROM events""",
)
def _insert_auto(spark, folder):
    # Item 0 fixes the columns: items of type "view" lack one, all have an extra one.
    event = F.col("event_type")
    size = F.when(event != "view", (F.col("user_id") % 50).cast("string"))
    json = F.to_json(
        F.struct(
            (F.col("event_id") + 1000000).alias("p_partkey"),
            event.alias("p_name"),
            F.col("value").alias("p_retailprice"),
            size.alias("p_size"),
        )
    )
    events = table(spark, folder, "events").select(F.col("event_id").alias("item"), json.alias("json"))
    part = table(spark, folder, "part").select(
        "p_partkey", "p_name", "p_brand", "p_size", "p_retailprice"
    )
    return insert_image(part, batch_rows(Items(events, json="json"), part.schema))


@checked(
    "insert_mapped",
    """SELECT s_suppkey, s_name, s_nationkey FROM supplier
       UNION ALL SELECT 500000 + c_custkey, c_name, 7 FROM customer""",
)
def _insert_mapped(spark, folder):
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("item"), (F.col("c_custkey") + 500000).alias("key"), "c_name"
    )
    supplier = table(spark, folder, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    mapping = {"s_suppkey": FromItem("key"), "s_name": FromItem("c_name"), "s_nationkey": "7"}
    return insert_image(supplier, batch_rows(Items(customers), supplier.schema, mapping))


@checked(
    "insert_mapping_per_item",
    """SELECT c_custkey AS item, CAST(c_custkey AS BIGINT) AS s_suppkey,
              CASE WHEN c_acctbal < 0 THEN NULL ELSE c_name END AS s_name FROM customer""",
)
def _insert_mapping_rows(spark, folder):
    # An item may map fewer columns than item 0 does.
    both = F.create_map(
        F.lit("s_suppkey"), F.col("c_custkey").cast("string"), F.lit("s_name"), F.col("c_name")
    )
    one = F.create_map(F.lit("s_suppkey"), F.col("c_custkey").cast("string"))
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("item"), F.when(F.col("c_acctbal") < 0, one).otherwise(both).alias("m")
    )
    rows = mapping_rows(customers, "m", table(spark, folder, "supplier").schema)
    return rows.withColumnRenamed(ITEM, "item")


# -- updates ---------------------------------------------------------------------------------------


def _update_statements():
    return {
        0: UpdateStatement(
            {"o_orderpriority": "0-NONE", "o_totalprice": "0"},
            [Condition("o_totalprice", "lessThan", "20000")],
        ),
        1: UpdateStatement(
            {"o_orderstatus": None},
            [Condition("o_orderpriority", "like", "0-%"), Condition("o_orderstatus", "equals", "P")],
        ),
        2: UpdateStatement(
            {"o_totalprice": 1.5},
            [Condition("o_orderstatus", "isNull"), Condition("o_orderkey", "equals", "7")],
            "OR",
        ),
    }


_FOLDED = """WITH a AS (SELECT * REPLACE (
      CASE WHEN o_totalprice < 20000 THEN '0-NONE' ELSE o_orderpriority END AS o_orderpriority,
      CASE WHEN o_totalprice < 20000 THEN 0 ELSE o_totalprice END AS o_totalprice),
      o_totalprice < 20000 AS h0 FROM orders),
   b AS (SELECT * REPLACE (CASE WHEN o_orderpriority LIKE '0-%' AND o_orderstatus = 'P' THEN NULL
      ELSE o_orderstatus END AS o_orderstatus),
      o_orderpriority LIKE '0-%' AND o_orderstatus = 'P' AS h1 FROM a),
   c AS (SELECT * REPLACE (CASE WHEN o_orderstatus IS NULL OR o_orderkey = 7 THEN 1.5
      ELSE o_totalprice END AS o_totalprice),
      o_orderstatus IS NULL OR o_orderkey = 7 AS h2 FROM b)
"""


@checked("update_statements", _FOLDED + "SELECT * EXCLUDE (h0, h1, h2) FROM c")
def _update_statements_image(spark, folder):
    return update_rows(table(spark, folder, "orders"), _update_statements()).image


@checked(
    "update_statements_counts",
    _FOLDED
    + """SELECT 0 AS item, count(*) FILTER (h0) AS "affectedRows" FROM c UNION ALL
         SELECT 1, count(*) FILTER (h1) FROM c UNION ALL SELECT 2, count(*) FILTER (h2) FROM c""",
)
def _update_statements_counts(spark, folder):
    change = update_rows(table(spark, folder, "orders"), _update_statements())
    return change.outcome.select("item", "affectedRows")


def _update_by_key(spark, folder):
    events = table(spark, folder, "events").select(
        F.col("event_id").alias("item"), "user_id", "event_type", "value"
    )
    return update_per_item(
        table(spark, folder, "customer"),
        Items(events),
        [
            Condition("c_custkey", "equals", FromItem("user_id")),
            Condition("c_nationkey", "lessThan", "20"),
        ],
        sets={
            "c_acctbal": FromItem("value"),
            "c_mktsegment": FromItem("event_type"),
            "c_name": "seen",
        },
    )


@checked(
    "update_per_item_equi",
    """SELECT c_custkey, CASE WHEN e.user_id IS NULL THEN c_name ELSE 'seen' END AS c_name,
              c_nationkey, CASE WHEN e.user_id IS NULL THEN c_acctbal ELSE value END AS c_acctbal,
              CASE WHEN e.user_id IS NULL THEN c_mktsegment ELSE event_type END AS c_mktsegment
       FROM customer c LEFT JOIN (SELECT user_id, event_type, value FROM events
            QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1) e
       ON c.c_custkey = e.user_id AND c.c_nationkey < 20""",
)
def _update_equi(spark, folder):
    return _update_by_key(spark, folder).image


@checked(
    "update_per_item_counts",
    """SELECT e.event_id AS item, count(c.c_custkey) AS "affectedRows" FROM events e
       LEFT JOIN customer c ON c.c_custkey = e.user_id AND c.c_nationkey < 20 GROUP BY 1""",
)
def _update_equi_counts(spark, folder):
    return _update_by_key(spark, folder).outcome.select("item", "affectedRows")


def _update_overlapping(spark, folder):
    # Each item raises balances that are below its floor, so later items see earlier results.
    items = _nation_items(spark, folder).select(
        "item",
        (F.col("item") * 400 - 1000).cast("double").alias("floor"),
        (F.col("item") * 450 - 900).cast("double").alias("raised"),
        "n_name",
    )
    return update_per_item(
        table(spark, folder, "customer"),
        Items(items),
        [Condition("c_acctbal", "lessThan", FromItem("floor"))],
        sets={"c_acctbal": FromItem("raised"), "c_mktsegment": FromItem("n_name")},
    )


_STEPS = """WITH RECURSIVE steps AS (
      SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 0 AS item, false AS hit
      FROM customer
      UNION ALL
      SELECT c_custkey, c_name, c_nationkey,
             CASE WHEN c_acctbal < n.n_nationkey * 400 - 1000 THEN n.n_nationkey * 450 - 900
                  ELSE c_acctbal END,
             CASE WHEN c_acctbal < n.n_nationkey * 400 - 1000 THEN n.n_name ELSE c_mktsegment END,
             item + 1, c_acctbal < n.n_nationkey * 400 - 1000
      FROM steps JOIN nation n ON n.n_nationkey = steps.item)
"""


@checked(
    "update_per_item_fold",
    _STEPS
    + """SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM steps
         WHERE item = (SELECT max(n_nationkey) + 1 FROM nation)""",
)
def _update_fold(spark, folder):
    return _update_overlapping(spark, folder).image


@checked(
    "update_per_item_fold_counts",
    _STEPS
    + """SELECT item - 1 AS item, count(*) FILTER (hit) AS "affectedRows" FROM steps
         WHERE item > 0 GROUP BY item""",
)
def _update_fold_counts(spark, folder):
    return _update_overlapping(spark, folder).outcome.select("item", "affectedRows")


def _update_bands(spark, folder):
    low = 1000 * F.col("value")
    events = table(spark, folder, "events").select(F.col("event_id").alias("item"), low.alias("low"), "event_type", "user_id")
    where = [*_in_band("o_totalprice"), Condition("o_orderstatus", "notEquals", "P")]
    sets = {"o_orderpriority": FromItem("event_type"), "o_custkey": FromItem("user_id")}
    items = Items(events.withColumn("high", F.col("low") + 100))
    return update_per_item(table(spark, folder, "orders"), items, where, sets=sets)


_IN_BAND = "o_totalprice >= 1000 * value AND o_totalprice < 1000 * value + 100 AND o_orderstatus != 'P'"


@checked(
    "update_per_item_between",
    f"""SELECT o.* REPLACE (CASE WHEN e.event_id IS NULL THEN o_orderpriority ELSE event_type END AS o_orderpriority,
          CASE WHEN e.event_id IS NULL THEN o_custkey ELSE user_id END AS o_custkey)
        FROM orders o LEFT JOIN (SELECT o_orderkey AS k, max(event_id) AS last FROM orders JOIN events ON {_IN_BAND}
          GROUP BY o_orderkey) ON k = o_orderkey LEFT JOIN events e ON e.event_id = last""",
)
def _update_between(spark, folder):
    return _update_bands(spark, folder).image


@checked(
    "update_per_item_between_counts",
    f"""SELECT event_id AS item, count(o_orderkey) AS "affectedRows" FROM events LEFT JOIN orders ON {_IN_BAND}
        GROUP BY event_id""",
)
def _update_between_counts(spark, folder):
    return _update_bands(spark, folder).outcome.select("item", "affectedRows")


@checked(
    "update_auto_map",
    """WITH last_value_of AS (SELECT user_id, value FROM events WHERE event_type = 'purchase'
            QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1),
       last_type_of AS (SELECT user_id, CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS t
            FROM events WHERE event_type != 'purchase'
            QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)
       SELECT c_custkey, c_name, c_nationkey,
              CASE WHEN v.user_id IS NULL THEN c_acctbal ELSE v.value END AS c_acctbal,
              CASE WHEN t.user_id IS NULL THEN c_mktsegment ELSE t.t END AS c_mktsegment
       FROM customer c LEFT JOIN last_value_of v ON v.user_id = c_custkey
                       LEFT JOIN last_type_of t ON t.user_id = c_custkey""",
)
def _update_auto(spark, folder):
    # Purchases set the balance only; errors clear the segment; the rest set the segment only.
    event, key = F.col("event_type"), F.col("user_id").alias("c_custkey")
    cleared = F.concat(F.lit('{"c_custkey": '), F.col("user_id"), F.lit(', "c_mktsegment": null}'))
    json = (
        F.when(event == "purchase", F.to_json(F.struct(key, F.col("value").alias("c_acctbal"))))
        .when(event == "error", cleared)
        .otherwise(F.to_json(F.struct(key, event.alias("c_mktsegment"))))
    )
    events = table(spark, folder, "events").select(F.col("event_id").alias("item"), json.alias("json"))
    return update_per_item(
        table(spark, folder, "customer"),
        Items(events, json="json"),
        [Condition("c_custkey", "equals", FromItem("c_custkey"))],
    ).image


@checked(
    "update_item_errors",
    """SELECT e.event_id AS item,
              CASE WHEN event_type = 'error' THEN -1 ELSE
                (SELECT count(*) FROM customer c WHERE c.c_custkey = e.user_id) END AS "affectedRows",
              CASE WHEN event_type = 'error'
                THEN 'Column "c_nationkey": v' || user_id || ' is not a valid int' ELSE 'none' END AS error
       FROM events e""",
)
def _update_errors(spark, folder):
    user = F.col("user_id").cast("string")
    value = F.when(F.col("event_type") == "error", F.concat(F.lit("v"), user)).otherwise(user)
    events = table(spark, folder, "events").select(
        F.col("event_id").alias("item"), "user_id", value.alias("value")
    )
    outcome = update_per_item(
        table(spark, folder, "customer"),
        Items(events),
        [Condition("c_custkey", "equals", FromItem("user_id"))],
        sets={"c_nationkey": FromItem("value")},
    ).outcome
    return outcome.select(
        "item",
        F.coalesce("affectedRows", F.lit(-1)).alias("affectedRows"),
        F.coalesce("error", F.lit("none")).alias("error"),
    )


# -- deletes ---------------------------------------------------------------------------------------


def _delete_statements():
    return {
        0: DeleteStatement([Condition("o_orderpriority", "equals", "5-LOW")]),
        1: DeleteStatement(
            [Condition("o_totalprice", "greaterThan", 400000), Condition("o_orderstatus", "equals", "F")]
        ),
        2: DeleteStatement([Condition("o_orderkey", "lessThan", "0")]),
    }


_FIRST = """SELECT *, CASE WHEN o_orderpriority = '5-LOW' THEN 0
      WHEN o_totalprice > 400000 AND o_orderstatus = 'F' THEN 1
      WHEN o_orderkey < 0 THEN 2 END AS first_item FROM orders"""


@checked("delete_statements", f"SELECT * EXCLUDE (first_item) FROM ({_FIRST}) WHERE first_item IS NULL")
def _delete_image(spark, folder):
    return delete_rows(table(spark, folder, "orders"), _delete_statements()).image


@checked(
    "delete_statements_counts",
    f"""SELECT item, count(first_item) AS "affectedRows" FROM (VALUES (0), (1), (2)) v(item)
        LEFT JOIN ({_FIRST}) ON first_item = item GROUP BY item""",
)
def _delete_counts(spark, folder):
    change = delete_rows(table(spark, folder, "orders"), _delete_statements())
    return change.outcome.select("item", "affectedRows")


def _delete_by_key(spark, folder):
    events = table(spark, folder, "events").select(F.col("event_id").alias("item"), "user_id")
    return delete_per_item(
        table(spark, folder, "orders"),
        Items(events),
        [
            Condition("o_custkey", "equals", FromItem("user_id")),
            Condition("o_orderstatus", "notEquals", "P"),
        ],
    )


@checked(
    "delete_per_item",
    """SELECT * FROM orders o WHERE NOT coalesce(o_orderstatus != 'P'
       AND o_custkey IN (SELECT user_id FROM events WHERE user_id IS NOT NULL), false)""",
)
def _delete_items(spark, folder):
    return _delete_by_key(spark, folder).image


@checked(
    "delete_per_item_counts",
    """WITH first_of AS (SELECT user_id, min(event_id) AS item FROM events GROUP BY user_id),
       n AS (SELECT item, count(*) AS c FROM orders JOIN first_of ON o_custkey = user_id
             WHERE o_orderstatus != 'P' GROUP BY item)
       SELECT event_id AS item, coalesce(c, 0) AS "affectedRows"
       FROM events LEFT JOIN n ON n.item = event_id""",
)
def _delete_item_counts(spark, folder):
    return _delete_by_key(spark, folder).outcome.select("item", "affectedRows")


def _delete_by_pattern(spark, folder):
    items = _nation_items(spark, folder).select(
        "item", F.concat(F.lit("%"), F.col("item") + 10).alias("pattern"), F.col("item").alias("n")
    )
    return delete_per_item(
        table(spark, folder, "orders").select("o_orderkey", "o_custkey"),
        Items(items),
        [
            Condition("o_orderkey", "like", FromItem("pattern")),
            Condition("o_custkey", "equals", FromItem("n")),
        ],
        "OR",
    )


_PATTERN_FIRST = """SELECT o_orderkey, o_custkey, min(n_nationkey) AS item FROM orders LEFT JOIN nation
   ON CAST(o_orderkey AS VARCHAR) LIKE '%' || (n_nationkey + 10) OR o_custkey = n_nationkey
   GROUP BY ALL"""


def _delete_bands(spark, folder):
    where = [*_in_band("o_totalprice"), Condition("o_orderstatus", "notEquals", "P")]
    return delete_per_item(table(spark, folder, "orders"), _price_bands(spark, folder, 100), where)


_FIRST_BAND = """SELECT o.o_orderkey, min(e.event_id) AS item FROM orders o JOIN events e
       ON o.o_totalprice >= 1000 * e.value AND o.o_totalprice < 1000 * e.value + 100 AND o.o_orderstatus != 'P'
       GROUP BY o.o_orderkey"""


@checked(
    "delete_per_item_between",
    f"SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ({_FIRST_BAND}))",
)
def _delete_between(spark, folder):
    return _delete_bands(spark, folder).image


@checked(
    "delete_per_item_between_counts",
    f"""SELECT e.event_id AS item, count(f.item) AS "affectedRows" FROM events e
        LEFT JOIN ({_FIRST_BAND}) f ON f.item = e.event_id GROUP BY e.event_id""",
)
def _delete_between_counts(spark, folder):
    return _delete_bands(spark, folder).outcome.select("item", "affectedRows")


@checked(
    "delete_per_item_pattern",
    f"SELECT o_orderkey, o_custkey FROM ({_PATTERN_FIRST}) WHERE item IS NULL",
)
def _delete_pattern(spark, folder):
    return _delete_by_pattern(spark, folder).image


@checked(
    "delete_per_item_pattern_counts",
    f"""SELECT n_nationkey AS item, count(p.item) AS "affectedRows"
        FROM nation LEFT JOIN ({_PATTERN_FIRST}) p ON p.item = n_nationkey GROUP BY n_nationkey""",
)
def _delete_pattern_counts(spark, folder):
    return _delete_by_pattern(spark, folder).outcome.select("item", "affectedRows")


# -- upserts ---------------------------------------------------------------------------------------


def _customer_source(spark, folder) -> DataFrame:
    """One row per ordering customer, half of them unknown to the table."""
    return (
        table(spark, folder, "orders")
        .groupBy("o_custkey")
        .agg(F.max("o_totalprice").alias("c_acctbal"))
        .select(
            F.col("o_custkey").alias(ITEM),
            (F.col("o_custkey") * 2).alias("c_custkey"),
            "c_acctbal",
            F.lit("ACTIVE").alias("c_mktsegment"),
        )
    )


_CUSTOMER_SOURCE = """SELECT o_custkey * 2 AS k, max(o_totalprice) AS b FROM orders GROUP BY o_custkey"""


@checked(
    "upsert_postimage",
    f"""SELECT coalesce(c_custkey, k) AS c_custkey, coalesce(c_name, '-') AS c_name,
               coalesce(b, c_acctbal) AS c_acctbal,
               CASE WHEN k IS NULL THEN c_mktsegment ELSE 'ACTIVE' END AS c_mktsegment
        FROM customer FULL JOIN ({_CUSTOMER_SOURCE}) ON c_custkey = k""",
)
def _upsert(spark, folder):
    source = _customer_source(spark, folder)
    check_source(source, ["c_custkey"])
    target = table(spark, folder, "customer").drop("c_nationkey")
    image = upsert_rows(target, source, ["c_custkey"]).image
    # Unmapped columns are NULL in inserted rows.
    return image.withColumn("c_name", F.coalesce("c_name", F.lit("-")))


@checked(
    "upsert_counts",
    f"""SELECT count(*) AS "affectedRows", count(c_custkey) AS "updatedRows",
               count(*) - count(c_custkey) AS "insertedRows"
        FROM ({_CUSTOMER_SOURCE}) LEFT JOIN customer ON c_custkey = k""",
)
def _upsert_counts(spark, folder):
    source = _customer_source(spark, folder)
    return upsert_rows(table(spark, folder, "customer"), source, ["c_custkey"]).counts


@checked(
    "upsert_composite_key",
    """WITH s AS (SELECT o_orderkey AS k1, CASE WHEN o_totalprice > 200000 THEN o_custkey
                         ELSE o_custkey + 1 END AS k2 FROM orders)
       SELECT coalesce(o_orderkey, k1) AS o_orderkey, coalesce(o_custkey, k2) AS o_custkey,
              CASE WHEN k1 IS NULL THEN o_orderstatus ELSE 'X' END AS o_orderstatus
       FROM orders FULL JOIN s ON o_orderkey = k1 AND o_custkey = k2""",
)
def _upsert_composite(spark, folder):
    orders = table(spark, folder, "orders")
    other = F.when(F.col("o_totalprice") > 200000, F.col("o_custkey"))
    source = orders.select(
        F.col("o_orderkey").alias(ITEM),
        "o_orderkey",
        other.otherwise(F.col("o_custkey") + 1).alias("o_custkey"),
        F.lit("X").alias("o_orderstatus"),
    )
    keys = ["o_orderkey", "o_custkey"]
    check_source(source, keys)
    target = orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    return upsert_rows(target, source, keys).image


def _line_source(spark, folder) -> DataFrame:
    """One row per order. Line 8 does not exist, so those rows are inserted."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias(ITEM),
        F.col("o_orderkey").alias("l_orderkey"),
        (F.col("o_custkey") % 8 + 1).cast("int").alias("l_linenumber"),
        F.lit(99.0).alias("l_quantity"),
    )


_LINE_SOURCE = """SELECT o_orderkey AS k1, CAST(o_custkey % 8 + 1 AS INTEGER) AS k2 FROM orders"""
_LINE_KEYS = ["l_orderkey", "l_linenumber"]


@checked(
    "upsert_repeated_target_keys",
    f"""SELECT l_orderkey, l_linenumber, l_partkey,
               CASE WHEN k1 IS NULL THEN l_quantity ELSE 99 END AS l_quantity
        FROM lineitem LEFT JOIN ({_LINE_SOURCE}) ON l_orderkey = k1 AND l_linenumber = k2
        UNION ALL
        SELECT k1, k2, NULL, 99 FROM ({_LINE_SOURCE}) WHERE NOT EXISTS
          (SELECT 1 FROM lineitem WHERE l_orderkey = k1 AND l_linenumber = k2)""",
)
def _upsert_repeated(spark, folder):
    source = _line_source(spark, folder)
    check_source(source, _LINE_KEYS)
    target = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity"
    )
    return upsert_rows(target, source, _LINE_KEYS).image


@checked(
    "upsert_repeated_target_key_counts",
    f"""SELECT u + i AS "affectedRows", u AS "updatedRows", i AS "insertedRows" FROM
        (SELECT count(l_orderkey) AS u, count(*) - count(l_orderkey) AS i FROM ({_LINE_SOURCE})
         LEFT JOIN lineitem ON l_orderkey = k1 AND l_linenumber = k2)""",
)
def _upsert_repeated_counts(spark, folder):
    source = _line_source(spark, folder)
    return upsert_rows(table(spark, folder, "lineitem"), source, _LINE_KEYS).counts


@checked(
    "upsert_insert_only",
    f"""SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem UNION ALL
        SELECT k1, k2, NULL FROM ({_LINE_SOURCE}) WHERE NOT EXISTS
          (SELECT 1 FROM lineitem WHERE l_orderkey = k1 AND l_linenumber = k2)""",
)
def _upsert_insert_only(spark, folder):
    source = _line_source(spark, folder).drop("l_quantity")
    target = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return upsert_rows(target, source, _LINE_KEYS).image


def _event_source(spark, folder) -> DataFrame:
    return table(spark, folder, "events").select(
        F.col("event_id").alias(ITEM), "user_id", "event_type", "value"
    )


@checked(
    "upsert_duplicate_keys",
    """SELECT user_id, event_type, count(*) AS "rows", min(event_id) AS first_item FROM events
       GROUP BY user_id, event_type HAVING count(*) > 1""",
)
def _duplicate_keys(spark, folder):
    return duplicate_keys(_event_source(spark, folder), ["user_id", "event_type"])


@checked(
    "upsert_duplicate_rows",
    """SELECT event_id AS item, user_id, value FROM events
       QUALIFY count(*) OVER (PARTITION BY user_id, value) > 1""",
)
def _duplicate_rows(spark, folder):
    rows = duplicate_rows(_event_source(spark, folder), ["user_id", "value"])
    return rows.withColumnRenamed(ITEM, "item")


@checked(
    "upsert_null_keys",
    f"""SELECT 1 AS position, 'quality' AS key, min(doc_id) AS item FROM ({_GRADED})
        WHERE quality IS NULL""",
)
def _null_keys(spark, folder):
    return null_keys(_graded(spark, folder).withColumn(ITEM, F.col("doc_id")), ["lang", "quality"])


# -- SQL text --------------------------------------------------------------------------------------

# Statements made from whole texts: quoted, as an identifier, as comments, and bare.
_TEMPLATES = (
    ("SELECT '", "' AS t FROM d"),
    ("INSERT INTO t SELECT '", "'"),
    ('SELECT "', '" FROM d'),
    ("SELECT 1 /* ", " */ FROM d"),
    ("SELECT 1 -- ", " \nFROM d"),
    ("SELECT ", " FROM d"),
    ("WITH a AS (SELECT '", "' AS t) DELETE FROM a"),
    ("SELECT a, 'into' INTO b FROM c -- '", "'"),
)


def _templates_sql() -> str:
    def text(value):
        return "'" + value.replace("'", "''") + "'"

    rows = ", ".join(f"({i}, {text(a)}, {text(b)})" for i, (a, b) in enumerate(_TEMPLATES))
    return f"(VALUES {rows}) v(kind, head, tail)"


@checked(
    "guard_verdicts",
    # The same rule in the other engine's regular expressions, which cannot back up anyway.
    """WITH s AS (SELECT doc_id, kind, head || text || tail AS q FROM documents, """
    + _templates_sql()
    + r"""),
       b AS (SELECT doc_id, kind, regexp_replace(q,
         '''[^''\\]*(?:(?:\\(?s:.)|'''')[^''\\]*)*''|"[^"\\]*(?:(?:\\(?s:.)|"")[^"\\]*)*"|`[^`]*(?:``[^`]*)*`|--[^\n]*|/\*(?s:.*?)\*/',
         ' ', 'g') AS bare FROM s),
       w AS (SELECT *, list_transform(regexp_extract_all(bare, '[A-Za-z_][A-Za-z0-9_]*'),
             lambda x: upper(x)) AS words FROM b)
       SELECT doc_id, kind, CASE WHEN regexp_matches(bare, '[''"`]|/\*') THEN 'unterminated'
         WHEN list_contains(words, 'SELECT') AND NOT list_has_any(words, ['INSERT', 'UPDATE',
           'DELETE', 'MERGE', 'CREATE', 'DROP', 'ALTER', 'TRUNCATE', 'GRANT', 'REVOKE', 'CALL',
           'INTO']) THEN 'read-only' ELSE 'not a select' END AS verdict FROM w""",
)
def _guard(spark, folder):
    templates = F.array(
        *[
            F.struct(F.lit(i).alias("kind"), F.lit(head).alias("head"), F.lit(tail).alias("tail"))
            for i, (head, tail) in enumerate(_TEMPLATES)
        ]
    )
    statements = table(spark, folder, "documents").select(
        "doc_id", "text", F.explode(templates).alias("t")
    )
    statements = statements.select(
        "doc_id", "t.kind", F.concat("t.head", "text", "t.tail").alias("statement")
    )
    return lexical_verdicts(statements, "statement").select("doc_id", "kind", "verdict")


@checked(
    "query_with_parameters",
    """WITH big AS (SELECT o_custkey, count(*) AS n FROM orders
                    WHERE o_totalprice > 100000 AND o_orderstatus = 'F' GROUP BY o_custkey)
       SELECT c_custkey, c_name, n FROM big JOIN customer ON c_custkey = o_custkey WHERE n >= 2""",
)
def _parameters(spark, folder):
    return spark.sql(
        """WITH big AS (SELECT o_custkey, count(*) AS n FROM {orders}
                        WHERE o_totalprice > ? AND o_orderstatus = ? GROUP BY o_custkey)
           SELECT c_custkey, c_name, n FROM big JOIN {customer} ON c_custkey = o_custkey
           WHERE n >= ?""",
        args=[100000, "F", 2],
        orders=table(spark, folder, "orders"),
        customer=table(spark, folder, "customer"),
    )


@checked(
    "sql_update_image",
    """SELECT c_custkey, c_name, c_nationkey,
              CASE WHEN c_nationkey < 10 AND c_acctbal > 0 THEN c_acctbal * 2 ELSE c_acctbal END AS c_acctbal,
              CASE WHEN c_nationkey < 10 AND c_acctbal > 0 THEN upper(c_name) ELSE c_mktsegment END AS c_mktsegment
       FROM customer""",
)
def _sql_update(spark, folder):
    statement = """UPDATE shop.customer AS c SET c_acctbal = c.c_acctbal * ?, c_mktsegment = upper(c_name)
                   WHERE c_nationkey < ? AND c.c_acctbal > 0"""
    return statement_change(spark, table(spark, folder, "customer"), statement, [2, 10]).image


_MERGE = """WITH latest AS (SELECT user_id, max_by(value, event_id) AS value, max_by(event_type, event_id) AS kind
       FROM parquet.`{folder}/events.parquet` GROUP BY user_id)
  MERGE INTO shop.customer AS c USING latest AS e ON (c.c_custkey = e.user_id AND c.c_nationkey < ?)
  WHEN MATCHED AND e.kind = 'error' THEN DELETE
  WHEN MATCHED AND e.value > ? THEN UPDATE SET c_acctbal = c.c_acctbal + e.value, c_mktsegment = upper(e.kind)
  WHEN NOT MATCHED AND e.value > ? THEN INSERT (c_custkey, c_name, c_acctbal) VALUES (e.user_id + ?, e.kind, e.value)
  WHEN NOT MATCHED BY SOURCE AND c.c_acctbal < 0 THEN UPDATE SET c_mktsegment = 'NONE'"""
_MERGED_SQL = """WITH latest AS (SELECT user_id, max_by(value, event_id) AS value, max_by(event_type, event_id) AS kind
       FROM events GROUP BY user_id),
  merged AS (SELECT *, CASE
      WHEN c_custkey IS NULL THEN CASE WHEN value > 20 THEN 'insert' END
      WHEN user_id IS NULL THEN CASE WHEN c_acctbal < 0 THEN 'mark' END
      WHEN kind = 'error' THEN 'delete' WHEN value > 50 THEN 'update' END AS action
    FROM customer FULL JOIN latest ON c_custkey = user_id AND c_nationkey < 18)
"""


def _merge_by_text(spark, folder):
    return merge_statement(spark, table(spark, folder, "customer"), _MERGE.format(folder=folder), [18, 50, 20, 1_000_000])


@checked(
    "sql_merge_image",
    _MERGED_SQL
    + """SELECT c_custkey, c_name, c_nationkey,
           CASE WHEN action = 'update' THEN c_acctbal + value ELSE c_acctbal END AS c_acctbal,
           CASE action WHEN 'update' THEN upper(kind) WHEN 'mark' THEN 'NONE' ELSE c_mktsegment END AS c_mktsegment
         FROM merged WHERE c_custkey IS NOT NULL AND action IS DISTINCT FROM 'delete'
         UNION ALL SELECT 1000000 + user_id, kind, NULL, value, NULL FROM merged WHERE action = 'insert'""",
)
def _merge_image(spark, folder):
    return _merge_by_text(spark, folder).image


@checked(
    "sql_merge_counts",
    _MERGED_SQL + """SELECT count(action) AS "affectedRows" FROM merged""",
)
def _merge_counts(spark, folder):
    return _merge_by_text(spark, folder).outcome


@checked(
    "sql_delete_image",
    """SELECT * FROM orders
       WHERE NOT coalesce(o_totalprice BETWEEN 1000 AND 200000 OR o_orderstatus = 'F', false)""",
)
def _sql_delete(spark, folder):
    statement = "DELETE FROM shop.orders WHERE o_totalprice BETWEEN ? AND ? OR o_orderstatus = 'F'"
    return statement_change(spark, table(spark, folder, "orders"), statement, [1000, 200000]).image


@checked(
    "sql_delete_counts",
    "SELECT count(*) AS affectedRows FROM lineitem WHERE l_discount > 0.05 AND l_returnflag <> 'N'",
)
def _sql_delete_counts(spark, folder):
    statement = "DELETE FROM lineitem WHERE l_discount > ? AND l_returnflag <> 'N'"
    return statement_change(spark, table(spark, folder, "lineitem"), statement, [0.05]).outcome.select("affectedRows")


# -- functions -------------------------------------------------------------------------------------


@checked(
    "fn_cut_middle",
    """SELECT doc_id, CASE WHEN n_chars - 2000 <= 0 OR n_chars // 2 <= n_chars - 2000
                             OR length(text) < n_chars - 2000 THEN text
         ELSE left(text, n_chars - 2000) || right(text, length(text) - n_chars // 2 + 1) END AS cut
       FROM documents""",
)
def _cut_middle(spark, folder):
    cut_from = (F.col("n_chars") - 2000).cast("int")
    cut_to = F.floor(F.col("n_chars") / 2).cast("int")
    return table(spark, folder, "documents").select(
        "doc_id", cut_middle(F.col("text"), cut_from, cut_to).alias("cut")
    )


@checked(
    "fn_factorial",
    """SELECT l_linenumber, count(*) AS n, CAST(sum(CAST(factorial(l_linenumber) AS BIGINT)) AS BIGINT) AS total
       FROM lineitem GROUP BY l_linenumber""",
)
def _factorial(spark, folder):
    return (
        table(spark, folder, "lineitem")
        .groupBy("l_linenumber")
        .agg(F.count("*").alias("n"), F.sum(factorial(F.col("l_linenumber"))).alias("total"))
    )


@checked(
    "udtf_fibonacci",
    """WITH RECURSIVE fib(num, val, nxt) AS (SELECT 0::BIGINT, 0::BIGINT, 1::BIGINT UNION ALL
         SELECT num + 1, nxt, val + nxt FROM fib WHERE num < 60)
       SELECT p_partkey, num, val FROM part JOIN fib ON num < p_size""",
)
def _fibonacci(spark, folder):
    rows = table(spark, folder, "part").select(
        "p_partkey", F.explode(fibonacci(F.col("p_size"))).alias("f")
    )
    return rows.select(
        "p_partkey", F.col("f.num").cast("bigint").alias("num"), F.col("f.val").cast("bigint").alias("val")
    )


@checked(
    "udaf_weighted_length",
    """SELECT lang, source, sum(length(text) * (doc_id % 4) * 0.5::DOUBLE) AS weighted
       FROM documents GROUP BY lang, source""",
)
def _weighted(spark, folder):
    weight = (F.col("doc_id") % 4) * F.lit(0.5)
    return (
        table(spark, folder, "documents")
        .groupBy("lang", "source")
        .agg(weighted_length(F.col("text"), weight).alias("weighted"))
    )


# -- jobs ------------------------------------------------------------------------------------------


@checked(
    "report_latest_month_top10",
    """SELECT l_suppkey AS carrier, count(*) AS flight_count, round(avg(l_quantity), 1) AS avg_delay
       FROM lineitem WHERE date_trunc('month', l_shipdate) =
         (SELECT date_trunc('month', max(l_shipdate)) FROM lineitem)
       GROUP BY l_suppkey ORDER BY flight_count DESC, carrier LIMIT 10""",
)
def report_latest_month_top10(spark, folder):
    return latest_month_report(
        table(spark, folder, "lineitem"), "l_shipdate", "l_suppkey", "l_quantity"
    )


_DAYS = """SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n,
   sum(CAST(o_totalprice AS DECIMAL(18,2))) AS r FROM orders GROUP BY 1"""


def _mart_rows(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("sales_date").cast("string").alias("sales_date"),
        F.col("transactions").cast("bigint").alias("transactions"),
        F.col("revenue").cast("double").alias("revenue"),
    )


@checked(
    "daily_revenue_mart",
    f"""SELECT CAST(d AS VARCHAR) AS sales_date, n AS transactions, CAST(r AS DOUBLE) AS revenue
        FROM ({_DAYS}) ORDER BY d DESC LIMIT 14""",
)
def _daily(spark, folder):
    return _mart_rows(daily_revenue(table(spark, folder, "orders"), "o_orderdate", "o_totalprice"))


@checked(
    "mart_refresh_read_back",
    f"""WITH days AS ({_DAYS}), newest AS (SELECT * FROM days ORDER BY d DESC LIMIT 14),
        mart AS (SELECT d, 0 AS n, CASE WHEN n > 6 THEN 0 ELSE 1 END AS r FROM days)
        SELECT CAST(mart.d AS VARCHAR) AS sales_date, coalesce(newest.n, mart.n) AS transactions,
               CAST(coalesce(newest.r, mart.r) AS DOUBLE) AS revenue
        FROM mart LEFT JOIN newest USING (d) WHERE coalesce(newest.r, mart.r) > 0""",
)
def _mart_refresh(spark, folder):
    orders = table(spark, folder, "orders")
    known = orders.groupBy(F.col("o_orderdate").cast("date").alias("sales_date")).agg(
        F.lit(0).cast("decimal(18,0)").alias("transactions"),
        F.when(F.count("*") > 6, 0).otherwise(1).cast("decimal(18,2)").alias("revenue"),
    )
    newest = daily_revenue(orders, "o_orderdate", "o_totalprice")
    source = newest.withColumn(ITEM, F.datediff("sales_date", F.lit("1970-01-01")).cast("bigint"))
    check_source(source, ["sales_date"])
    return _mart_rows(positive_days(upsert_rows(known, source, ["sales_date"]).image))


@checked(
    "contact_lifecycle",
    """SELECT c_custkey AS id, c_name AS full_name, lower(c_name) || '@example.com' AS email,
              'active' AS status FROM customer WHERE c_acctbal >= 0""",
)
def _contacts(spark, folder):
    domain = F.when(F.col("c_acctbal") >= 0, "@example.com").otherwise("@invalid")
    items = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("item"),
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("full_name"),
        F.concat(F.lower("c_name"), domain).alias("email"),
        F.lit("new").alias("status"),
    )
    empty = spark.createDataFrame([], "id bigint, full_name string, email string, status string")
    inserted = insert_image(empty, batch_rows(Items(items), empty.schema))
    activate = UpdateStatement(
        {"status": "active"}, [Condition("email", "like", "%@example.com")]
    )
    updated = update_rows(inserted, {0: activate}).image
    kept = delete_rows(updated, {0: DeleteStatement([Condition("status", "equals", "new")])}).image
    return select_rows(kept, sort=[SortRule("id")])
