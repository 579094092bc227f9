"""Item batches: a DataFrame of requests, each row one item with a 0-based index.

An item's values are either typed columns (every item has the same keys) or one column of JSON
text (keys may differ from item to item). ``bind_items`` coerces the values a template needs to the
types of the target table and splits off the items whose values do not fit.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..errors import TableOperationError, require_column_name
from ..functions.predicates import Condition, FromItem, check_conditions, right_hand_type
from ..functions.values import (
    assignment_cast,
    assignment_literal,
    col,
    comparison_cast,
    is_integer,
    key_cast,
    storage_type,
)
from .scratch import pinned

ITEM = "__item"
_ERROR = "__error"
_JSON = "__json"


@dataclass(frozen=True)
class Items:
    """A batch of items. ``index`` names the 0-based position column, ``json`` the JSON text column
    (None: every other column is a key)."""

    df: DataFrame
    index: str = "item"
    json: str | None = None

    @property
    def columns(self) -> list[str]:
        return [name for name in self.df.columns if name != self.index]

    def first_keys(self) -> list[str]:
        """The keys of item 0 in their own order; empty when there is no item 0."""
        if self.json is None:
            return self.columns
        row = (
            self.df.where(col(self.index) == 0)
            .select(F.json_object_keys(col(self.json)).alias("keys"))
            .first()
        )
        return list(row.keys or []) if row is not None else []

    def opened(self) -> DataFrame:
        """The batch with ``__item`` and, for JSON items, the parsed object as ``__json``."""
        opened = self.df.withColumn(ITEM, col(self.index).cast("bigint"))
        if self.json is None:
            return opened
        return opened.withColumn(_JSON, F.from_json(col(self.json), "map<string,string>"))

    def value(self, name: str) -> tuple[Column, T.DataType]:
        """The item's value under ``name``: NULL where the key is missing."""
        if self.json is not None:
            return F.col(_JSON)[name], T.StringType()
        if name not in self.columns:
            return F.lit(None).cast("string"), T.StringType()
        return col(name), self.df.schema[name].dataType

    def nested(self, name: str) -> Column:
        """True where the value is an array or an object; for columns that ``may_nest``."""
        if self.json is not None:
            # Text may look like an array or object too. Only then the value's kind is looked up.
            text = F.col(_JSON)[name]
            kind = F.schema_of_variant(F.from_json(col(self.json), "map<string,variant>")[name])
            nested = kind.startswith("ARRAY") | kind.startswith("OBJECT")
            return F.when(text.startswith("{") | text.startswith("["), nested).otherwise(False)
        return col(name).isNotNull()

    def may_nest(self, name: str) -> bool:
        if self.json is not None:
            return True
        nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
        return name in self.columns and isinstance(self.df.schema[name].dataType, nested)

    def malformed(self) -> Column:
        """For JSON items: True where the text is not an object."""
        return F.col(_JSON).isNull()


def index_items(df: DataFrame, order_by: Sequence[str | Column], index: str = "item") -> DataFrame:
    """Number the rows 0, 1, 2, … in the order of ``order_by`` without a single-task sort.

    The rows are range-partitioned and sorted, and pinned once: the range bounds are sampled, so
    counting and numbering must look at the same partitions. The driver sees one number per
    partition.
    """
    # The input position breaks ties, so one value held by many rows spans several partitions.
    position = F.monotonically_increasing_id()
    ordering = [*[col(by) if isinstance(by, str) else by for by in order_by], F.col("__tie")]
    ranged = (
        df.withColumn("__tie", position)
        .repartitionByRange(*ordering)
        .sortWithinPartitions(*ordering)
        .drop("__tie")
        .withColumn("__slice", F.shiftright(position, 33))
        .withColumn("__at", position.bitwiseAND(F.lit((1 << 33) - 1)))
    )
    ranged = pinned(ranged)
    sizes = dict(ranged.groupBy("__slice").agg(F.count("*").alias("n")).collect())
    starts, total = [], 0
    for slice_id in sorted(sizes):
        starts.append((int(slice_id), total))
        total += sizes[slice_id]
    offsets = df.sparkSession.createDataFrame(starts, "__slice bigint, __start bigint")
    numbered = ranged.join(F.broadcast(offsets), "__slice")
    return numbered.select(
        (F.col("__start") + F.col("__at")).alias(index), *[col(name) for name in df.columns]
    )


def items_from_objects(spark: SparkSession, objects: Sequence[Mapping]) -> Items:
    """A batch from Python objects, kept as JSON text so each item has its own keys."""
    import json

    rows = [(position, json.dumps(dict(obj))) for position, obj in enumerate(objects)]
    return Items(spark.createDataFrame(rows, "item bigint, json string"), json="json")


@dataclass(frozen=True)
class Bound:
    """Items ready for a template.

    ``valid`` holds ``__item``, ``__w<i>`` (value of the i-th condition) and, per mapped column j,
    ``__s<j>`` (value) and ``__h<j>`` (does this item set it). ``errors`` holds (item, error).
    """

    valid: DataFrame
    errors: DataFrame
    columns: tuple[str, ...]


def json_keys_used(items: Items, columns: Sequence[str]) -> list[str]:
    """Which of the given columns any item names; at most one value per column is collected."""
    keys = items.opened().select(F.explode(F.map_keys(_JSON)).alias("key"))
    rows = keys.where(F.col("key").isin(list(columns))).distinct().collect()
    used = {row.key for row in rows}
    return [name for name in columns if name in used]


def bind_items(
    items: Items,
    schema: T.StructType,
    conditions: Sequence[Condition] = (),
    combine: str = "AND",
    sets: Mapping[str, object] | None = None,
    auto_map: bool = False,
) -> Bound:
    """Coerce what a template takes from each item; items that do not fit become error rows."""
    check_conditions(conditions, combine, schema.names)
    problems: list[tuple[Column, Column]] = []
    outputs: list[Column] = [F.col(ITEM)]
    if items.json is not None:
        problems.append((items.malformed(), F.lit("Item is not a JSON object.")))

    for position, condition in enumerate(conditions):
        if not condition.uses_item:
            continue
        raw, source = items.value(condition.value.name)
        dtype = right_hand_type(condition, schema[condition.column].dataType)
        value = comparison_cast(raw, source, storage_type(dtype))
        label = f'Where column "{condition.column}"'
        problems += _value_problems(items, condition.value.name, raw, value, dtype, label)
        if condition.operator == "equals" and is_integer(dtype) and source != dtype:
            value = key_cast(value, dtype)
        outputs.append(value.alias(f"__w{position}"))

    mapping: list[tuple[str, object, Column]] = []
    if auto_map and items.json is not None:
        for name in json_keys_used(items, schema.names):
            present = F.map_contains_key(F.col(_JSON), name)
            mapping.append((name, FromItem(name), present))
        unknown = F.array_except(F.map_keys(_JSON), F.array(*[F.lit(n) for n in schema.names]))
        problems.append(
            (
                F.size(unknown) > 0,
                F.concat(F.lit("Unknown column(s): "), F.array_join(unknown, ", ")),
            )
        )
        problems.append((F.size(F.col(_JSON)) == 0, F.lit("No columns to update.")))
    elif auto_map:
        mapping = [(name, FromItem(name), F.lit(True)) for name in items.columns]
    else:
        mapping = [(name, value, F.lit(True)) for name, value in (sets or {}).items()]

    for position, (name, value, present) in enumerate(mapping):
        require_column_name(name, "Column name")
        if name not in schema.names:
            raise TableOperationError(f'Column "{name}" does not exist.')
        dtype = schema[name].dataType
        if isinstance(value, FromItem):
            raw, source = items.value(value.name)
            stored = assignment_cast(raw, source, dtype)
            label = f'Column "{name}"'
            problems += _value_problems(items, value.name, raw, stored, dtype, label)
        else:
            stored = assignment_literal(value, dtype)
        outputs.append(stored.cast(storage_type(dtype)).alias(f"__s{position}"))
        outputs.append(present.alias(f"__h{position}"))

    opened = items.opened()
    columns = tuple(name for name, _, _ in mapping)
    if not problems:
        none = opened.sparkSession.createDataFrame([], "item bigint, error string")
        return Bound(opened.select(*outputs), none, columns)
    message = F.coalesce(*[F.when(failed, text) for failed, text in problems])
    checked = opened.select(*outputs, message.alias(_ERROR))
    return Bound(
        valid=checked.where(F.col(_ERROR).isNull()).drop(_ERROR),
        errors=checked.where(F.col(_ERROR).isNotNull()).select(
            F.col(ITEM).alias("item"), F.col(_ERROR).alias("error")
        ),
        columns=columns,
    )


def _value_problems(items: Items, name: str, raw: Column, value: Column, dtype, label: str):
    """What can be wrong with a value; nothing where it is used as it is."""
    found = []
    if items.may_nest(name):
        text = F.lit(f"{label}: a nested value needs an explicit conversion")
        found.append((items.nested(name), text))
    if value is not raw:
        text = F.concat(
            F.lit(f"{label}: "), raw.cast("string"), F.lit(f" is not a valid {dtype.simpleString()}")
        )
        found.append((raw.isNotNull() & value.isNull(), text))
    return found
