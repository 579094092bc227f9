"""How a set of items meets the rows of a table.

Four ways, none of which pairs every item with every row in a join:

* **by key**: item-dependent conditions are ``equals`` joined by AND, so rows and items meet in an equi
  join;
* **by tiles** (``bands``): conditions joined by AND that compare a column with an item's value;
* **by patterns** (``patterns``): conditions joined by AND, one of them a pattern of the item's;
* **by array**: anything else. A slice of the items becomes one array value (a scalar subquery) and
  each row filters that array: a narrow plan, rows stay where they are.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Collection, Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..errors import TableOperationError
from ..functions.predicates import Condition, predicate
from ..functions.values import col, widens
from ..sources.items import ITEM, Bound

# Items per array value. A slice is a few hundred kilobytes, whatever the number of items.
ITEMS_PER_SLICE = 4096
ITEM_ARRAY = "__items"


@dataclass(frozen=True)
class KeyMatch:
    """Equi-join form of a template: ``keys`` are positions of the key conditions."""

    keys: tuple[int, ...]
    residual: tuple[Condition, ...]


def key_match(conditions: Sequence[Condition], combine: str) -> KeyMatch | None:
    """The equi-join form, or None when the template has none."""
    taken = [i for i, c in enumerate(conditions) if c.uses_item]
    if not taken or (combine != "AND" and len(conditions) > 1):
        return None
    if any(conditions[i].operator != "equals" for i in taken):
        return None
    rest = tuple(c for c in conditions if not c.uses_item)
    return KeyMatch(tuple(taken), rest)


def has_key(conditions: Sequence[Condition], combine: str) -> bool:
    """Whether one condition among others that must hold together is an equality with an item's value:
    rows and items then meet in an equi join that tests the others on its pairs."""
    return combine == "AND" and any(c.uses_item and c.operator == "equals" for c in conditions)


def require_item_value(conditions: Sequence[Condition]) -> None:
    if not any(c.uses_item for c in conditions):
        raise TableOperationError(
            "No condition takes a value from the items, so every item would match the same rows; "
            "run the operation once instead."
        )


def key_equality(conditions: Sequence[Condition], match: KeyMatch) -> Column:
    """Target columns equal to the items' key columns; NULL never matches."""
    equal = None
    for position in match.keys:
        test = col(conditions[position].column) == F.col(f"__w{position}")
        equal = test if equal is None else equal & test
    return equal


def key_columns(match: KeyMatch) -> list[str]:
    return [f"__w{position}" for position in match.keys]


def rows_per_key(
    df: DataFrame, per_key: DataFrame, conditions: Sequence[Condition], match: KeyMatch, small: bool
) -> DataFrame:
    """How many table rows hold each key: the key columns and ``affectedRows``.

    Reads only the columns of the conditions. Rows are combined per key before the shuffle, so one
    frequent key costs one row per task. A small set of keys also drops all other rows before it.
    """
    if match.residual:
        df = df.where(predicate(df.schema, match.residual))
    names = [col(name) for name in dict.fromkeys(conditions[i].column for i in match.keys)]
    rows = df.select(*names)
    if small:
        keys = F.broadcast(per_key.select(*key_columns(match)))
        rows = rows.join(keys, key_equality(conditions, match), "left_semi")
    return rows.groupBy(*names).agg(F.count("*").alias("affectedRows"))


def array_predicate(
    schema: T.StructType, conditions: Sequence[Condition], combine: str, item: Column, column_of=col
) -> Column:
    """The template for one element of an item array; NULL counts as no match."""
    test = predicate(
        schema,
        conditions,
        combine,
        column_of=column_of,
        item_value=lambda position: item.getField(f"__w{position}"),
    )
    return F.coalesce(test, F.lit(False))


def envelope(
    df: DataFrame,
    bound: Bound,
    conditions: Sequence[Condition],
    combine: str,
    changing: Collection[str] = (),
) -> Column | None:
    """A plain filter that every row matched by some item passes; None where there is none.

    A comparison with an item's value is widened to the smallest or largest value of all items, a
    scalar that reaches the scan. Rows outside never look at the array of items. Columns in
    ``changing`` take new values while items are applied, so conditions on them say nothing.
    """
    tests = []
    for position, condition in enumerate(conditions):
        test = None
        if condition.column not in changing:
            test = _widened(df, bound, position, condition)
        if test is not None:
            tests.append(test)
        elif combine == "OR":
            return None
    if not tests:
        return None
    return functools.reduce(operator.or_ if combine == "OR" else operator.and_, tests)


def _widened(df: DataFrame, bound: Bound, position: int, condition: Condition) -> Column | None:
    if not condition.uses_item:
        return predicate(df.schema, [condition])
    value, column = F.col(f"__w{position}"), col(condition.column)
    # In the column's own type, where that changes nothing: a cast would keep the filter from the
    # scan.
    dtype, given = df.schema[condition.column].dataType, bound.valid.schema[f"__w{position}"].dataType
    if isinstance(dtype, T.DoubleType) or widens(given, dtype):
        value = value.cast(dtype)
    low, high = bound.valid.agg(F.min(value)), bound.valid.agg(F.max(value))
    if condition.operator in ("lessThan", "lessThanOrEqual"):
        return column <= high.scalar()
    if condition.operator in ("greaterThan", "greaterThanOrEqual"):
        return column >= low.scalar()
    if condition.operator == "equals":
        return (column >= low.scalar()) & (column <= high.scalar())
    return None


def item_slices(bound: Bound) -> Iterator[Column]:
    """The items as array values of bounded size, in item order, each to be added to the rows as
    column ``__items``. A slice is a number of items, whatever their indexes are."""
    rest, before = bound.valid, None
    while True:
        some = rest.select(ITEM).orderBy(ITEM).limit(ITEMS_PER_SLICE)
        last = some.agg(F.max(ITEM)).first()[0]
        if last is None:
            return
        part = rest.where(F.col(ITEM) <= last)
        fields = F.struct(ITEM, *[name for name in part.columns if name != ITEM])
        yield part.agg(F.sort_array(F.collect_list(fields))).scalar()
        before = last
        rest = bound.valid.where(F.col(ITEM) > before)
