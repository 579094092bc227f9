"""What a write operation yields: the table afterwards and the rows affected per item."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

OUTCOME_SCHEMA = "item bigint, affectedRows bigint, error string"


@dataclass(frozen=True)
class Change:
    """A set-based change as independent lazy plans.

    ``image`` is the table afterwards, ``outcome`` has (item, affectedRows, error) for every item,
    ``touched`` holds the table rows that are hit and ``added`` rows that are new. ``columns`` names
    the columns the change may alter in existing rows.
    """

    image: DataFrame
    outcome: DataFrame
    touched: DataFrame
    columns: tuple[str, ...] = ()
    added: DataFrame | None = None


def outcome_rows(spark: SparkSession, rows) -> DataFrame:
    return spark.createDataFrame(list(rows), OUTCOME_SCHEMA)


def counted(rows: DataFrame, marks: dict) -> DataFrame:
    """Rows hit per statement, in one aggregation; ``marks`` maps items to boolean columns."""
    sums = rows.agg(*[F.count_if(mark).alias(f"hit_{item}") for item, mark in marks.items()])
    pairs = F.array(
        *[
            F.struct(
                F.lit(item).cast("bigint").alias("item"),
                F.col(f"hit_{item}").alias("affectedRows"),
            )
            for item in marks
        ]
    )
    return sums.select(F.explode(pairs).alias("o")).select(
        "o.item", "o.affectedRows", F.lit(None).cast("string").alias("error")
    )


def counted_rows() -> Column:
    """The affected rows of an item that may have matched nothing."""
    return F.coalesce("affectedRows", F.lit(0).cast("bigint")).alias("affectedRows")


def with_errors(counts: DataFrame, errors: DataFrame) -> DataFrame:
    """One outcome row per item: its count or its error."""
    done = counts.select("item", "affectedRows", F.lit(None).cast("string").alias("error"))
    failed = errors.select("item", F.lit(None).cast("bigint").alias("affectedRows"), "error")
    return done.unionByName(failed)
