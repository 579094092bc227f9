"""The shipped jobs: a report on the newest month, a daily revenue mart, a contact list's life."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from ..functions.ordering import SortRule
from ..functions.predicates import Condition, FromItem
from ..functions.values import col
from ..operations import DeleteRequest, SelectRequest, TableOperations, UpdateRequest
from ..operators.select import select_rows
from ..sources.items import ITEM, Items


def latest_month_report(
    facts: DataFrame, when: str, group: str, measure: str, n: int = 10
) -> DataFrame:
    """The ``n`` groups with most rows in the newest month, with their rounded average measure.

    The month is found first, as a scalar: it comes from one column, and it becomes a range on that
    column in the second scan, which skips the files and row groups of all other months.
    """
    latest = facts.agg(F.date_trunc("month", F.max(when)).cast("timestamp_ntz").alias("month"))
    return (
        facts.where(col(when) >= latest.scalar())
        .groupBy(col(group).alias("carrier"))
        .agg(
            F.count("*").alias("flight_count"),
            F.round(F.avg(col(measure)), 1).alias("avg_delay"),
        )
        .orderBy(F.desc("flight_count"), F.asc("carrier"))
        .limit(n)
    )


def daily_revenue(sales: DataFrame, day: str, price: str, days: int = 14) -> DataFrame:
    """Transactions and revenue of the newest ``days`` days.

    Prices are summed as decimals, so the result does not depend on the order of addition.
    """
    return (
        sales.groupBy(col(day).cast("date").alias("sales_date"))
        .agg(
            F.count("*").cast("decimal(18,0)").alias("transactions"),
            F.round(F.sum(col(price).cast("decimal(18,2)")), 2)
            .cast("decimal(18,2)")
            .alias("revenue"),
        )
        .orderBy(F.desc("sales_date"))
        .limit(days)
    )


# The columns of the mart and of the contact list.
MART_COLUMNS = "sales_date DATE, transactions DECIMAL(18,0), revenue DECIMAL(18,2)"
CONTACT_COLUMNS = (
    "id DECIMAL(9,0), full_name VARCHAR(200), email VARCHAR(320), status VARCHAR(20), "
    "signup_date DATE, updated_at TIMESTAMP_NTZ"
)


def refresh_revenue_mart(
    operations: TableOperations, schema: str, table: str, sales: DataFrame, day: str, price: str
) -> tuple[int, DataFrame]:
    """Create the mart if needed, merge the newest days by date, read the positive days back.

    Returns (affected rows, the mart newest first). Running it again refreshes the same days.
    """
    operations.store.create(
        schema,
        table,
        MART_COLUMNS,
        constraints=[{"type": "PRIMARY KEY", "name": f"{table}_pk", "columns": ["sales_date"]}],
        if_not_exists=True,
    )
    newest = daily_revenue(sales, day, price)
    # The items are days: a day's distance to a fixed date numbers them without a sort.
    items = newest.withColumn("item", F.datediff("sales_date", F.lit("1970-01-01")).cast("bigint"))
    outcome = operations.upsert(
        schema, table, Items(items), ["sales_date"], mapping=_same_names(newest)
    ).first()
    rows, _ = operations.select(
        SelectRequest(
            schema,
            table,
            [Condition("revenue", "greaterThan", "0")],
            sort=[SortRule("sales_date", "DESC")],
        )
    )
    return outcome.affectedRows, rows


def _same_names(df: DataFrame) -> Mapping[str, object]:
    return {name: FromItem(name) for name in df.columns if name not in ("item", ITEM)}


def contact_lifecycle(
    operations: TableOperations,
    schema: str,
    table: str,
    contacts: Items,
    stamp: dt.datetime,
    valid_pattern: str = "%@example.com",
) -> tuple[dict[str, int], DataFrame]:
    """Recreate the list, insert the contacts, activate those with a valid address, drop the rest,
    read back by id."""
    operations.store.create(
        schema,
        table,
        CONTACT_COLUMNS,
        constraints=[{"type": "PRIMARY KEY", "name": f"{table}_pk", "columns": ["id"]}],
        or_replace=True,
    )
    counts = {}
    counts["inserted"] = operations.insert(schema, table, contacts).first().affectedRows
    counts["updated"] = (
        operations.update(
            UpdateRequest(
                schema,
                table,
                {"status": "active", "updated_at": stamp},
                [Condition("email", "like", valid_pattern)],
            )
        )
        .first()
        .affectedRows
    )
    counts["deleted"] = (
        operations.delete(DeleteRequest(schema, table, [Condition("status", "equals", "new")]))
        .first()
        .affectedRows
    )
    rows, _ = operations.select(SelectRequest(schema, table, sort=[SortRule("id")]))
    return counts, rows


def positive_days(mart: DataFrame) -> DataFrame:
    """The mart's days with revenue, newest first."""
    return select_rows(
        mart,
        [Condition("revenue", "greaterThan", "0")],
        sort=[SortRule("sales_date", "DESC")],
    )
