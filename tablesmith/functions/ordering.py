"""Sort rules, limits and top-n per group."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..errors import TableOperationError
from .values import col

# Directions and the limit used when a limited read names none.
DIRECTIONS = ("ASC", "DESC")
DEFAULT_LIMIT = 50

# Up to this many rows per group Spark itself drops surplus rows before the shuffle of a
# row_number filter (spark.sql.optimizer.windowGroupLimitThreshold).
_PRE_SHUFFLE_LIMIT = 1000


@dataclass(frozen=True)
class SortRule:
    column: str
    direction: str = "ASC"


def sort_columns(
    columns: Sequence[str], rules: Sequence[SortRule], nulls: str = "last"
) -> list[Column]:
    if nulls not in ("first", "last"):
        raise TableOperationError(f"Invalid null placement: {nulls!r}")
    ordering = []
    for rule in rules:
        if not isinstance(rule.column, str) or not rule.column.strip():
            raise TableOperationError("Sort column must not be empty.")
        if rule.direction not in DIRECTIONS:
            raise TableOperationError(
                f"A sort rule goes ASC or DESC, not {rule.direction!r}"
            )
        if rule.column not in columns:
            raise TableOperationError(f'Sort column "{rule.column}" does not exist.')
        method = f"{rule.direction.lower()}_nulls_{nulls}"
        ordering.append(getattr(col(rule.column), method)())
    return ordering


def positive_integer(value, label: str = "Limit") -> int:
    """A positive whole number; text such as "10" is accepted."""
    number = value
    if isinstance(value, str):
        try:
            number = float(value)
        except ValueError:
            number = None
    whole = (
        isinstance(number, (int, float))
        and not isinstance(number, bool)
        and number == number
        and number not in (float("inf"), float("-inf"))
        and number == int(number)
        and number > 0
    )
    if not whole:
        raise TableOperationError(f"{label} is {value!r}, which is no positive integer")
    return int(number)


def top_n(df: DataFrame, groups: Sequence[str], ordering: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of every group, exactly.

    Small ``n``: Spark plans a group limit before the shuffle, so one huge group sends only ``n``
    rows per task. Large ``n``: the group is first cut into one slice per input partition, each
    keeping ``n`` rows.
    """
    keys = [col(name) for name in groups]
    ordering = list(ordering) or [F.lit(1).asc()]
    if n >= _PRE_SHUFFLE_LIMIT:
        slices = Window.partitionBy(*keys, "__slice").orderBy(*ordering)
        df = df.withColumn("__slice", F.spark_partition_id())
        df = df.withColumn("__rank", F.row_number().over(slices)).where(F.col("__rank") <= n)
        df = df.drop("__rank", "__slice")
    window = Window.partitionBy(*keys).orderBy(*ordering)
    ranked = df.withColumn("__rank", F.row_number().over(window))
    return ranked.where(F.col("__rank") <= n).drop("__rank")
