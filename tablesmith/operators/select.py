"""Structured reads: filter, sort, limit; for one request, or for a whole set of items."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..errors import TableOperationError
from ..functions.ordering import DEFAULT_LIMIT, SortRule, positive_integer, sort_columns, top_n
from ..functions.predicates import Condition, predicate
from ..functions.values import col
from ..sources.items import ITEM, Items, bind_items
from ..sources.scratch import fits_broadcast, join_side
from .bands import band_match, first_rows_by_bands, only_band, select_by_bands
from .matching import (
    ITEM_ARRAY,
    array_predicate,
    envelope,
    has_key,
    item_slices,
    key_columns,
    key_equality,
    key_match,
    require_item_value,
)
from .patterns import keyed_items, pattern_match, select_by_patterns


def select_rows(
    df: DataFrame,
    where: Sequence[Condition] = (),
    combine: str = "AND",
    sort: Sequence[SortRule] = (),
    limit=None,
    *,
    nulls: str = "last",
    full_match: bool = False,
) -> DataFrame:
    """Every column of the rows that satisfy the conditions, sorted, then limited.

    ``limit=None`` returns all rows. With a sort, a limit is planned as a top-k.
    """
    test = predicate(df.schema, where, combine, full_match=full_match)
    ordering = sort_columns(df.columns, sort, nulls)
    if test is not None:
        df = df.where(test)
    if ordering:
        df = df.orderBy(*ordering)
    return df if limit is None else df.limit(positive_integer(limit))


def limited(return_all: bool = True, limit=DEFAULT_LIMIT):
    """The limit of a request: none when everything is returned, else a checked number."""
    return None if return_all else positive_integer(limit)


def result_cap(df: DataFrame, cap: int) -> DataFrame:
    """A bound on the rows one result may have; 0 means none."""
    if isinstance(cap, bool) or not isinstance(cap, int) or cap < 0:
        raise TableOperationError(f"Result cap must be 0 or a positive integer, got: {cap!r}")
    return df if cap == 0 else df.limit(cap)


def unique_names(df: DataFrame) -> DataFrame:
    """A result whose column names are keys: of two columns with one name the last value wins and
    the first position is kept."""
    if len(set(df.columns)) == len(df.columns):
        return df
    last = {name: position for position, name in enumerate(df.columns)}
    names = list(dict.fromkeys(df.columns))
    numbered = df.toDF(*[f"__c{position}" for position in range(len(df.columns))])
    return numbered.select(*[F.col(f"__c{last[name]}").alias(name) for name in names])


def tagged(df: DataFrame, item: int) -> DataFrame:
    """Rows with the item that caused them."""
    return df.select(F.lit(item).cast("bigint").alias("item"), *[col(n) for n in df.columns])


def concatenated(results: Sequence[DataFrame]) -> DataFrame:
    """The results of several items as one relation; columns a result lacks are NULL."""
    return functools.reduce(
        lambda left, right: left.unionByName(right, allowMissingColumns=True), results
    )


def select_per_item(
    df: DataFrame,
    items: Items,
    where: Sequence[Condition],
    combine: str = "AND",
    sort: Sequence[SortRule] = (),
    limit=None,
    *,
    nulls: str = "last",
    ordered: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """One read per item, as one plan: (rows with their ``item``, error rows).

    A sort decides which rows of an item a limit keeps. ``ordered`` also sorts the relation by item
    and then by the rules, as the results of single reads one after the other would be; that costs
    a shuffle of the result.
    """
    require_item_value(where)
    ordering = sort_columns(df.columns, sort, nulls)
    n = None if limit is None else positive_integer(limit)
    bound = bind_items(items, df.schema, where, combine)
    columns = [col(name) for name in df.columns]
    item = F.col(ITEM).alias("item")
    match = key_match(where, combine)
    band = band_match(where, combine)
    pattern = pattern_match(where, combine)

    if match is not None:
        rows = df
        if match.residual:
            rows = rows.where(predicate(df.schema, match.residual))
        small = fits_broadcast(bound.valid)
        if small:
            # Rows that no item asks for don't reach the shuffle of the cut below.
            keys = F.broadcast(bound.valid.select(*key_columns(match)).distinct())
            rows = rows.join(keys, key_equality(where, match), "left_semi") if n is not None else rows
            near = envelope(df, bound, where, combine)
            rows = rows if near is None else rows.where(near)
        if n is not None:
            # Rows with one key are the same rows for every item with that key, so they are cut
            # before the join and at most n of them meet each item.
            names = [where[position].column for position in match.keys]
            rows = top_n(rows, list(dict.fromkeys(names)), ordering, n)
        wanted = F.broadcast(bound.valid) if small else bound.valid
        found = join_side(rows, False) if n is not None and not small else rows
        found = found.join(wanted, key_equality(where, match)).select(item, *columns)
    else:
        near = envelope(df, bound, where, combine)
        df = df if near is None else df.where(near)
        if has_key(where, combine):
            wanted = F.broadcast(bound.valid) if fits_broadcast(bound.valid) else bound.valid
            pairs = predicate(df.schema, where, combine, item_value=lambda i: F.col(f"__w{i}"))
            found = df.join(wanted, pairs).select(item, *columns)
        elif band is not None and n is not None and sort and sort[0].column == band.column and only_band(where, band):
            falling = sort[0].direction == "DESC"
            found = first_rows_by_bands(df, bound, where, band, ordering, falling, n)
        elif band is not None:
            found = select_by_bands(df, bound, where, band)
        elif pattern is not None:
            items = keyed_items(df, bound, where, pattern)
            found = select_by_patterns(df, items.keyed, where, pattern)
            found = found.unionAll(_select_by_array(df, items.rest, where, combine))
        else:
            found = _select_by_array(df, bound, where, combine)
        if n is not None:
            found = top_n(found, ["item"], ordering, n)
    if ordered:
        found = found.orderBy("item", *ordering)
    return found, bound.errors


def _select_by_array(df, bound, where, combine):
    """Every row with every item that asks for it: each row filters the items, slice by slice."""
    columns = [col(name) for name in df.columns]

    def asking(item):
        return array_predicate(df.schema, where, combine, item)

    found = [
        df.withColumn(ITEM_ARRAY, slice_).select(
            F.explode(F.filter(ITEM_ARRAY, asking).getField(ITEM)).alias("item"), *columns
        )
        for slice_ in item_slices(bound)
    ]
    return concatenated(found or [df.select(F.lit(0).cast("bigint").alias("item"), *columns).where("false")])
