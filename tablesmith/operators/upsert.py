"""Keyed upsert: update the rows whose key is known, insert the rest, refuse unclear keys first."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..errors import TableOperationError
from ..functions.values import col
from ..sources.items import ITEM
from ..sources.scratch import fits_broadcast, join_side

def check_key_columns(columns: Sequence[str], keys: Sequence[str]) -> None:
    """The key list must be non-empty, hold real names, and be part of the mapped columns."""
    if not keys:
        raise TableOperationError("An upsert needs the names of the columns that identify a row.")
    if any(not isinstance(key, str) or not key.strip() for key in keys):
        raise TableOperationError("A key column has no name.")
    unknown = [key for key in keys if key not in columns]
    if unknown:
        raise TableOperationError(
            f"The source has no column {', '.join(unknown)} to match by; it has {', '.join(columns)}."
        )


def null_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per key column, the first source row without a value: (key, item), key columns in order."""
    firsts = [F.min(F.when(col(key).isNull(), F.col(ITEM))).alias(f"k{i}") for i, key in enumerate(keys)]
    found = source.agg(*firsts)
    pairs = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"), F.lit(key).alias("key"), F.col(f"k{i}").alias("item")
            )
            for i, key in enumerate(keys)
        ]
    )
    return (
        found.select(F.explode(pairs).alias("p"))
        .where(F.col("p.item").isNotNull())
        .select("p.position", "p.key", "p.item")
    )


def duplicate_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values held by more than one source row: the key, how many rows, the first of them.

    Counts are combined before the shuffle, so a key held by most rows is no heavier than others.
    """
    return (
        source.groupBy(*[col(key) for key in keys])
        .agg(F.count("*").alias("rows"), F.min(ITEM).alias("first_item"))
        .where(F.col("rows") > 1)
    )


def duplicate_rows(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every source row (item and key) that shares its key with another one."""
    repeated = duplicate_keys(source, keys).select(*[col(key).alias(f"__d_{key}") for key in keys])
    on = _equal([(col(key), col(f"__d_{key}")) for key in keys])
    side = join_side(repeated, fits_broadcast(repeated))
    return source.select(ITEM, *[col(key) for key in keys]).join(side, on, "left_semi")


def check_source(source: DataFrame, keys: Sequence[str]) -> None:
    """Raise before anything is written when a key is NULL or held by several source rows.

    One job: the rows are combined per key first, and both verdicts come from the combined rows.
    """
    grouped = source.groupBy(*[col(key).alias(f"k{i}") for i, key in enumerate(keys)]).agg(
        F.count("*").alias("rows"), F.min(ITEM).alias("first_item")
    )
    missing = [
        F.min(
            F.when(F.col(f"k{i}").isNull(), F.struct(F.col("first_item"), F.lit(i).alias("key")))
        )
        for i in range(len(keys))
    ]
    group = F.struct("first_item", "rows", *[f"k{i}" for i in range(len(keys))])
    verdict = grouped.agg(
        (F.least(*missing) if len(missing) > 1 else missing[0]).alias("missing"),
        F.min(F.when(F.col("rows") > 1, group)).alias("repeated"),
    ).first()
    if verdict.missing is not None:
        item, key = verdict.missing
        raise TableOperationError(
            f'Item {item}: "{keys[key]}" is NULL, and an upsert can match no row by it.',
            item,
        )
    if verdict.repeated is None:
        return
    group = {key: verdict.repeated[f"k{i}"] for i, key in enumerate(keys)}
    first_item, count = verdict.repeated.first_item, verdict.repeated.rows
    same = _equal([(col(key), F.lit(group[key])) for key in keys])
    rows = source.where(same).select(F.col(ITEM).alias("item"), *[col(key) for key in keys])
    values = ", ".join(f"{key} = {group[key]!r}" for key in keys)
    raise TableOperationError(
        f"{count} items, the first of them {first_item}, claim the row with {values}; which one "
        "wins is not defined.",
        first_item,
        rows,
    )


def _equal(pairs) -> Column:
    equal = None
    for left, right in pairs:
        test = left == right
        equal = test if equal is None else equal & test
    return equal


@dataclass(frozen=True)
class Upsert:
    """Lazy plans of a checked upsert: the table afterwards and the affected rows."""

    updated: DataFrame
    inserted: DataFrame
    counts: DataFrame
    touched: DataFrame
    columns: tuple[str, ...]

    @property
    def image(self) -> DataFrame:
        return self.updated.unionByName(self.inserted)


def upsert_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> Upsert:
    """Merge ``source`` (``__item`` and mapped columns, keys unique and non-NULL) into ``target``.

    Matched target rows take every mapped non-key column, each of them if a key is repeated in the
    table; unmatched source rows are added, columns they do not map being NULL. When all mapped
    columns are keys there is nothing to update and matches do not count as affected.

    A source proven small is broadcast: the table is then neither shuffled nor sorted. A large one
    meets the table in a shuffled join with the table on the left, where Spark can split a skewed
    partition; the table's keys are reduced to one row per key before they are used to find the
    new source rows.
    """
    mapped = [name for name in source.columns if name != ITEM]
    check_key_columns(mapped, keys)
    unknown = [name for name in mapped if name not in target.columns]
    if unknown:
        raise TableOperationError(f"Unknown column(s): {', '.join(unknown)}", 0)
    updates = [name for name in mapped if name not in keys]
    renamed = source.select(*[col(name).alias(f"__s_{name}") for name in mapped])
    source_keys = renamed.select(*[col(f"__s_{key}") for key in keys])
    on = _equal([(col(key), col(f"__s_{key}")) for key in keys])
    small = fits_broadcast(renamed)

    updated = target
    if updates:
        side = join_side(renamed.withColumn("__matched", F.lit(True)), small)
        joined = target.join(side, on, "left")
        updated = joined.select(
            *[
                F.when(F.col("__matched"), col(f"__s_{name}")).otherwise(col(name)).alias(name)
                if name in updates
                else col(name)
                for name in target.columns
            ]
        )

    rows = target.select(*[col(key) for key in keys])
    if small:
        rows = rows.join(F.broadcast(source_keys), on, "left_semi")
    sizes = rows.groupBy(*[col(key) for key in keys]).agg(F.count("*").alias("__rows"))
    unmatched = renamed.join(sizes, on, "left_anti")
    inserted = unmatched.select(
        *[
            (col(f"__s_{name}") if name in mapped else F.lit(None))
            .cast(target.schema[name].dataType)
            .alias(name)
            for name in target.columns
        ]
    )
    matched_rows = F.sum("__rows") if updates else F.lit(0)
    counts = source_keys.join(sizes, on, "left").agg(
        F.coalesce(matched_rows, F.lit(0)).cast("bigint").alias("updatedRows"),
        F.count_if(F.col("__rows").isNull()).alias("insertedRows"),
    )
    counts = counts.select(
        (F.col("updatedRows") + F.col("insertedRows")).alias("affectedRows"),
        "updatedRows",
        "insertedRows",
    )
    touched = target.join(join_side(source_keys, small), on, "left_semi") if updates else target.where("false")
    return Upsert(updated, inserted, counts, touched, tuple(updates))
