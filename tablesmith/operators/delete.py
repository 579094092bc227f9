"""Delete: literal statements, or one plan for a whole set of items."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.predicates import Condition, predicate
from ..functions.values import col
from ..sources.items import ITEM, Items, bind_items
from ..sources.scratch import fits_broadcast, join_side
from .bands import band_match, first_by_bands, only_band
from .change import Change, counted, counted_rows, with_errors
from .matching import (
    ITEM_ARRAY,
    array_predicate,
    envelope,
    item_slices,
    key_columns,
    key_equality,
    key_match,
    require_item_value,
    rows_per_key,
)
from .patterns import first_by_patterns, keyed_items, pattern_match
from .update import require_where

_FIRST, _KEYED = "__first", "__keyed"


@dataclass(frozen=True)
class DeleteStatement:
    where: Sequence[Condition]
    combine: str = "AND"
    test: Column | None = None


def delete_rows(df: DataFrame, statements: Mapping[int, DeleteStatement]) -> Change:
    """Literal statements in item order. A row is counted for the first statement that matches it;
    rows whose conditions are NULL stay."""
    names = df.columns
    first = F.lit(None).cast("bigint")
    for item, statement in sorted(statements.items(), reverse=True):
        test = statement.test
        if test is None:
            require_where(statement.where, "Delete", item)
            test = predicate(df.schema, statement.where, statement.combine)
        first = F.when(test, F.lit(item).cast("bigint")).otherwise(first)
    marked = df.withColumn(_FIRST, first)
    hits = {item: F.col(_FIRST) == item for item in sorted(statements)}
    return Change(
        image=marked.where(F.col(_FIRST).isNull()).select(*[col(name) for name in names]),
        outcome=counted(marked, hits),
        touched=marked.where(F.col(_FIRST).isNotNull()),
    )


def delete_per_item(
    df: DataFrame, items: Items, where: Sequence[Condition], combine: str = "AND"
) -> Change:
    """One delete per item, in item order, as one plan."""
    require_where(where, "Delete")
    require_item_value(where)
    bound = bind_items(items, df.schema, where, combine)
    names = [col(name) for name in df.columns]
    match = key_match(where, combine)
    band = band_match(where, combine)
    pattern = pattern_match(where, combine)
    if match is not None:
        keys = key_columns(match)
        per_key = bound.valid.groupBy(*keys).agg(F.min(ITEM).alias(_FIRST))
        small = fits_broadcast(per_key)
        side = join_side(per_key, small)
        on = key_equality(where, match)
        if match.residual:
            on = on & predicate(df.schema, match.residual)
        image = df.join(side, on, "left_anti")
        hit = df.join(side, on, "left_semi")
        sizes = rows_per_key(df, per_key, where, match, small)
        counts = per_key.join(
            F.broadcast(sizes) if small else sizes, key_equality(where, match)
        ).select(F.col(_FIRST).alias("item"), "affectedRows")
        if small:
            counts = F.broadcast(counts)
    else:
        near = envelope(df, bound, where, combine)
        if band is not None and only_band(where, band):
            marked = first_by_bands(df, bound, where, band, _FIRST)
        elif pattern is not None:
            items = keyed_items(df if near is None else df.where(near), bound, where, pattern)
            marked = _first_by_array(df, items.rest, where, combine, near)
            marked = first_by_patterns(marked, items.keyed, where, pattern, _KEYED)
            marked = marked.withColumn(_FIRST, F.least(_FIRST, _KEYED)).drop(_KEYED)
        else:
            marked = _first_by_array(df, bound, where, combine, near)
        image = marked.where(F.col(_FIRST).isNull()).select(*names)
        hit = marked if near is None else marked.where(near)
        hit = hit.where(F.col(_FIRST).isNotNull())
        counts = hit.groupBy(F.col(_FIRST).alias("item"))
        counts = counts.agg(F.count("*").alias("affectedRows"))
    valid = bound.valid.select(F.col(ITEM).alias("item"))
    counts = valid.join(counts, "item", "left").select("item", counted_rows())
    return Change(image, with_errors(counts, bound.errors), hit)


def _first_by_array(df, bound, where, combine, near):
    """All rows with the first item that matches each: every row tries the items, slice by slice."""
    marked = df.withColumn(_FIRST, F.lit(None).cast("bigint"))
    for slice_ in item_slices(bound):
        matching = F.filter(ITEM_ARRAY, lambda x: array_predicate(df.schema, where, combine, x))
        first = F.try_element_at(matching, F.lit(1)).getField(ITEM)
        first = first if near is None else F.when(near, first)
        marked = marked.withColumn(ITEM_ARRAY, slice_)
        marked = marked.withColumn(_FIRST, F.coalesce(_FIRST, first)).drop(ITEM_ARRAY)
    return marked
