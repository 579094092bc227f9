"""Batch insert: all items become rows of one append."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F, types as T

from ..errors import TableOperationError, require_column_name
from ..functions.predicates import FromItem
from ..functions.values import assignment_cast, assignment_literal, storage_type
from ..sources.items import ITEM, Items


def mapped_columns(items: Items, mapping: Mapping[str, object] | None) -> list[str]:
    """The column list of the batch: the explicit mapping's, or item 0's keys."""
    if mapping is not None:
        return [require_column_name(name, "Column name", 0) for name in mapping]
    return items.first_keys()


def batch_rows(
    items: Items,
    schema: T.StructType,
    mapping: Mapping[str, object] | None = None,
    *,
    purpose: str = "insert",
) -> DataFrame:
    """``__item`` and the mapped columns, cast to the target's types.

    Item 0 fixes the column list; later items get NULL for keys they lack and their extra keys are
    dropped. A value that does not fit its column fails the whole batch when the rows are written.
    """
    columns = mapped_columns(items, mapping)
    if not columns:
        raise TableOperationError(
            f"Nothing to {purpose}: neither a mapping nor the first item names a column.",
            0,
        )
    unknown = [name for name in columns if name not in schema.names]
    if unknown:
        raise TableOperationError(f"Unknown column(s): {', '.join(unknown)}", 0)
    values = []
    for name in columns:
        dtype = schema[name].dataType
        given = FromItem(name) if mapping is None else mapping[name]
        if isinstance(given, FromItem):
            value = _strict_value(items, given.name, dtype)
        else:
            value = assignment_literal(given, dtype)
        values.append(value.cast(storage_type(dtype)).alias(name))
    opened = items.opened()
    if items.json is not None:
        broken = F.raise_error(F.concat(F.lit("Item is not a JSON object: item "), F.col(ITEM)))
        opened = opened.withColumn(
            "__json", F.when(items.malformed(), broken).otherwise(F.col("__json"))
        )
    return opened.select(ITEM, *values)


def _strict_value(items: Items, name: str, dtype: T.DataType):
    """The item's value cast to the column's type, raising where it does not fit."""
    raw, source = items.value(name)
    value = assignment_cast(raw, source, dtype)
    message = F.concat(
        F.lit("Item "),
        F.col(ITEM).cast("string"),
        F.lit(f': "{name}" = '),
        raw.cast("string"),
        F.lit(f" is not a valid {dtype.simpleString()}"),
    )
    checked = F.when(raw.isNotNull() & value.isNull(), F.raise_error(message)).otherwise(value)
    checked = checked if value is not raw else value
    if items.may_nest(name):
        item = F.col(ITEM).cast("string")
        text = F.concat(F.lit("Item "), item, F.lit(f': "{name}" is nested'))
        checked = F.when(items.nested(name), F.raise_error(text)).otherwise(checked)
    return checked


def mapping_rows(df: DataFrame, mappings: str, schema: T.StructType, index: str = "item"):
    """Rows from a per-item mapping column (``MAP<STRING, STRING>``: column name to value).

    Item 0's names fix the column list. An item naming another column is an error; an item naming
    fewer gets NULL for the rest.
    """
    first = df.where(F.col(index) == 0).select(F.map_keys(mappings).alias("names")).first()
    columns = [] if first is None else list(first.names or [])
    for name in columns:
        require_column_name(name, "Column name", 0)
    known = F.array(*[F.lit(name) for name in columns]).cast("array<string>")
    strange = F.array_except(F.map_keys(mappings), known)
    # min over structs: the first offending item and its names, with map-side combine.
    offender = (
        df.where(F.size(strange) > 0)
        .agg(F.min(F.struct(F.col(index).alias("item"), strange.alias("names"))).alias("first"))
        .first()
    )
    if offender.first is not None:
        item, names = offender.first
        raise TableOperationError(
            f"Item {item} fills {', '.join(names)}, but the first item's mapping fills only "
            f"{', '.join(columns)}, and a batch has one list of columns.",
            item,
        )
    values = df.select(index, *[F.col(mappings)[name].alias(name) for name in columns])
    return batch_rows(Items(values, index), schema)


def insert_image(target: DataFrame, rows: DataFrame) -> DataFrame:
    """The table after an append: columns no item maps are NULL in the new rows."""
    return target.unionByName(rows.drop(ITEM), allowMissingColumns=True)
