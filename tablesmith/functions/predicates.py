"""Structured conditions turned into one boolean Column."""

from __future__ import annotations

import functools
import operator as op
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, functions as F, types as T

from ..errors import TableOperationError, require_column_name
from .values import col, comparison_literal, is_text

# The condition operators and combinators of the request format.
OPERATORS = (
    "equals",
    "notEquals",
    "lessThan",
    "lessThanOrEqual",
    "greaterThan",
    "greaterThanOrEqual",
    "like",
    "notLike",
    "regexpLike",
    "notRegexpLike",
    "isNull",
    "isNotNull",
)
COMBINATORS = ("AND", "OR")

_COMPARE = {
    "equals": op.eq,
    "notEquals": op.ne,
    "lessThan": op.lt,
    "lessThanOrEqual": op.le,
    "greaterThan": op.gt,
    "greaterThanOrEqual": op.ge,
}
_PATTERN = ("like", "notLike", "regexpLike", "notRegexpLike")
_NULL_TEST = ("isNull", "isNotNull")


@dataclass(frozen=True)
class FromItem:
    """Stands for "the value this item has under ``name``" in a condition or mapping."""

    name: str


@dataclass(frozen=True)
class Condition:
    column: str
    operator: str
    value: object = None

    @property
    def takes_value(self) -> bool:
        return self.operator not in _NULL_TEST

    @property
    def uses_item(self) -> bool:
        return self.takes_value and isinstance(self.value, FromItem)


def check_conditions(conditions: Sequence[Condition], combine: str, columns: Sequence[str]) -> None:
    """Refuse malformed conditions before any plan exists."""
    if not conditions:
        return
    if combine not in COMBINATORS:
        raise TableOperationError(
            f"Conditions are joined by AND or OR, not by {combine!r}"
        )
    for condition in conditions:
        if condition.operator not in OPERATORS:
            raise TableOperationError(f"There is no condition operator {condition.operator!r}")
        require_column_name(condition.column, "Where column")
        if condition.column not in columns:
            raise TableOperationError(f'Where column "{condition.column}" does not exist.')


def test_column(
    condition: Condition,
    column: Column,
    dtype: T.DataType,
    value: Column | None,
    full_match: bool = False,
) -> Column:
    """One condition. ``value`` is the right-hand side; NULL tests ignore it."""
    name = condition.operator
    if name == "isNull":
        return column.isNull()
    if name == "isNotNull":
        return column.isNotNull()
    if name in _COMPARE:
        return _COMPARE[name](column, value)
    text = column if is_text(dtype) else column.cast("string")
    if name in ("like", "notLike"):
        matched = F.like(text, value)
    elif full_match:
        matched = F.rlike(text, F.concat(F.lit("^(?:"), value, F.lit(")$")))
    else:
        matched = F.rlike(text, value)
    return ~matched if name.startswith("not") else matched


def right_hand_type(condition: Condition, dtype: T.DataType) -> T.DataType:
    """Patterns are text whatever the column's type is."""
    return T.StringType() if condition.operator in _PATTERN else dtype


def predicate(
    schema: T.StructType,
    conditions: Sequence[Condition],
    combine: str = "AND",
    *,
    column_of: Callable[[str], Column] = col,
    item_value: Callable[[int], Column] | None = None,
    full_match: bool = False,
) -> Column | None:
    """All conditions under one combinator; None when there are none.

    ``column_of`` says how a target column is read, ``item_value`` how the value of the i-th
    condition is read when it comes from an item.
    """
    check_conditions(conditions, combine, schema.names)
    if not conditions:
        return None
    tests = []
    for position, condition in enumerate(conditions):
        dtype = schema[condition.column].dataType
        if condition.uses_item:
            if item_value is None:
                raise TableOperationError("A value taken from an item needs a set of items")
            value = item_value(position)
        elif condition.takes_value:
            value = comparison_literal(condition.value, right_hand_type(condition, dtype))
        else:
            value = None
        tests.append(test_column(condition, column_of(condition.column), dtype, value, full_match))
    return functools.reduce(op.and_ if combine == "AND" else op.or_, tests)


def describe(conditions: Sequence[Condition], combine: str) -> str:
    """The conditions as readable text, for error messages."""
    parts = [
        f'"{c.column}" {c.operator}' + (f" {c.value!r}" if c.takes_value else "")
        for c in conditions
    ]
    return f" {combine} ".join(parts)
