"""Update: literal statements folded over the rows, or one plan for a whole set of items."""

from __future__ import annotations

import functools
import operator as op
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from ..errors import TableOperationError, require_column_name
from ..functions.predicates import Condition, FromItem, predicate
from ..functions.values import assignment_literal, col, storage_type
from ..sources.items import ITEM, Items, bind_items
from ..sources.scratch import fits_broadcast, join_side
from .bands import Tiles, band_match, counts_by_bands, last_by_bands, only_band
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


@dataclass(frozen=True)
class UpdateStatement:
    """SET columns to literal values where the conditions hold."""

    sets: Mapping[str, object]
    where: Sequence[Condition]
    combine: str = "AND"
    # SET expressions over the row's own columns, for statements given as SQL text.
    expressions: Mapping[str, Column] = field(default_factory=dict)
    test: Column | None = None


def require_where(where: Sequence[Condition], verb: str, item: int | None = None) -> None:
    if not where:
        raise TableOperationError(
            f"This {verb} has no condition and would reach the whole table; state which rows it is for.",
            item,
        )


def update_rows(df: DataFrame, statements: Mapping[int, UpdateStatement]) -> Change:
    """Literal statements applied in item order in one pass over the rows.

    Each statement sees the values the earlier ones left, so SET and WHERE may overlap.
    """
    names = df.columns
    hits = {}
    for item, statement in sorted(statements.items()):
        if not statement.sets and not statement.expressions:
            raise TableOperationError("No columns to update. Name at least one column.", item)
        test = statement.test
        if test is None:
            require_where(statement.where, "Update", item)
            test = predicate(df.schema, statement.where, statement.combine)
        mark = f"__hit_{item}"
        df = df.withColumn(mark, F.coalesce(test, F.lit(False)))
        values = dict(statement.expressions)
        for name, value in statement.sets.items():
            require_column_name(name, "Column name", item)
            if name not in names:
                raise TableOperationError(f'Column "{name}" does not exist.', item)
            values[name] = assignment_literal(value, df.schema[name].dataType)
        changed = {
            name: F.when(F.col(mark), value).otherwise(col(name)).cast(
                storage_type(df.schema[name].dataType)
            )
            for name, value in values.items()
        }
        df = df.withColumns(changed)
        hits[item] = F.col(mark)
    changed = {name for s in statements.values() for name in (*s.sets, *s.expressions)}
    return Change(
        image=df.select(*[col(name) for name in names]),
        outcome=counted(df, hits),
        touched=df.where(functools.reduce(op.or_, hits.values())),
        columns=tuple(sorted(changed)),
    )


def update_per_item(
    df: DataFrame,
    items: Items,
    where: Sequence[Condition],
    combine: str = "AND",
    sets: Mapping[str, object] | None = None,
) -> Change:
    """One update per item, in item order, as one plan. Without ``sets`` the columns come from each
    item's own keys (a key that is absent leaves its column alone, a null value clears it)."""
    require_where(where, "Update")
    require_item_value(where)
    bound = bind_items(items, df.schema, where, combine, sets, auto_map=sets is None)
    if not bound.columns:
        raise TableOperationError("No columns to update. Name at least one column.", 0)
    match, band = key_match(where, combine), band_match(where, combine)
    changed = {name: position for position, name in enumerate(bound.columns)}
    if match is not None:
        for position in match.keys:
            name = where[position].column
            given = FromItem(name) if sets is None else sets.get(name)
            if given == where[position].value:
                # The matched rows already hold this value.
                changed.pop(name, None)
    if match is not None and changed.keys().isdisjoint(c.column for c in where):
        image, counts, touched = _update_by_key(df, bound, changed, where, match)
    elif band is not None and only_band(where, band) and changed.keys().isdisjoint(c.column for c in where):
        image, counts, touched = _update_by_bands(df, bound, changed, where, band)
    else:
        image, counts, touched = _update_by_array(df, bound, changed, where, combine)
    return Change(image, with_errors(counts, bound.errors), touched, tuple(changed))


def _update_by_key(df, bound, changed, where, match):
    """No statement can change which rows another one matches, so per key only the last value per
    column counts. The items collapse to one row per key before they meet the table."""
    keys = key_columns(match)
    last = []
    for position in changed.values():
        value = F.when(
            F.col(f"__h{position}"), F.struct(F.col(ITEM), F.col(f"__s{position}").alias("v"))
        )
        last.append(F.max_by(value, F.when(value.isNotNull(), F.col(ITEM))).alias(f"__v{position}"))
    per_key = bound.valid.groupBy(*keys).agg(*last, F.lit(True).alias("__matched"))
    small = fits_broadcast(per_key)
    side = join_side(per_key, small)

    on = key_equality(where, match)
    if match.residual:
        on = on & predicate(df.schema, match.residual)
    joined = df.join(side, on, "left")
    image = joined.select(
        *[
            F.when(F.col(f"__v{changed[name]}").isNotNull(), F.col(f"__v{changed[name]}.v"))
            .otherwise(col(name))
            .alias(name)
            if name in changed
            else col(name)
            for name in df.columns
        ]
    )

    sizes = rows_per_key(df, per_key, where, match, small)
    counts = bound.valid.join(
        join_side(sizes, small), key_equality(where, match), "left"
    ).select(F.col(ITEM).alias("item"), counted_rows())
    return image, counts, df.join(side, on, "left_semi")


def _update_by_bands(df, bound, changed, where, band):
    """As by key: no statement can change which rows another one matches, so the last one counts."""
    tiles = Tiles(bound, where, band)
    marked = last_by_bands(df, tiles, where, list(changed.values()))
    image = marked.select(
        *[
            F.when(F.col(f"__v{changed[name]}").isNotNull(), F.col(f"__v{changed[name]}.v"))
            .otherwise(col(name))
            .alias(name)
            if name in changed
            else col(name)
            for name in df.columns
        ]
    )
    hit = functools.reduce(op.or_, [F.col(f"__v{j}").isNotNull() for j in changed.values()])
    valid = bound.valid.select(F.col(ITEM).alias("item"))
    counts = valid.join(counts_by_bands(df, tiles.items, where, band), "item", "left").select("item", counted_rows())
    return image, counts, marked.where(hit)


def _update_by_array(df, bound, changed, where, combine):
    """The items as an array, folded over each row in item order: every item sees what the earlier
    ones left. Narrow: rows stay where they are."""
    names = df.columns
    near = envelope(df, bound, where, combine, changed)
    image = df.withColumn("__hits", F.lit(None).cast("array<bigint>"))
    for slice_ in item_slices(bound):
        start = F.struct(
            *[col(name).alias(name) for name in changed],
            F.coalesce("__hits", F.array().cast("array<bigint>")).alias("__hits"),
        )

        def step(state, item):
            def read(name):
                return state.getField(name) if name in changed else col(name)

            hit = array_predicate(df.schema, where, combine, item, read)
            return F.struct(
                *[
                    F.when(hit & item.getField(f"__h{j}"), item.getField(f"__s{j}"))
                    .otherwise(state.getField(name))
                    .alias(name)
                    for name, j in changed.items()
                ],
                F.when(hit, F.array_append(state.getField("__hits"), item.getField(ITEM)))
                .otherwise(state.getField("__hits"))
                .alias("__hits"),
            )

        image = image.withColumn(ITEM_ARRAY, slice_)
        state = F.aggregate(ITEM_ARRAY, start, step)
        state = state if near is None else F.when(near, state).otherwise(start)
        image = image.withColumn("__state", state)
        image = image.select(
            *[
                F.col("__state").getField(name).alias(name) if name in changed else col(name)
                for name in names
            ],
            F.col("__state").getField("__hits").alias("__hits"),
        )
    counts = (
        image.select(F.explode("__hits").alias("item"))
        .groupBy("item")
        .agg(F.count("*").alias("affectedRows"))
    )
    valid = bound.valid.select(F.col(ITEM).alias("item"))
    counts = valid.join(counts, "item", "left").select("item", counted_rows())
    return image.drop("__hits"), counts, image.where(F.size("__hits") > 0)
