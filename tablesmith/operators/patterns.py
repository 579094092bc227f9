"""Items that ask for text by patterns meet its rows by a fragment that every match must hold.

A literal run at a fixed distance from the start or end of the text is a fragment as a whole, with its place.
The other literal runs, the pieces between a pattern's wildcards, are cut into grams of ``GRAM`` characters. Of
a pattern's fragments the one that the fewest rows hold becomes its key. A row offers each of its own
distinct fragments of the shapes in use once, so it meets a pattern at most once, in an equi join, and only
what meets is matched in full.

* A pattern whose key no row holds meets nothing. The count of keys is combined before its shuffle, and left
  out for patterns with one fragment.
* A pattern without a run in a fixed place or of ``GRAM`` characters, or one that is not surely understood here
  (alternatives at the top, flags, back references, escapes in ``like``), has no key; the caller tries these
  on every row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.predicates import Condition, predicate
from ..functions.values import col, is_text
from ..sources.items import ITEM, Bound
from ..sources.scratch import fits_broadcast, join_side, pinned

GRAM = 3
#: The longest fragment in a fixed place, and its largest distance from the start or end: they bound the
#: shapes that a row has to offer.
LONGEST = 16
FARTHEST = 4
_GRAM, _GRAMS, _ROWS, _EXACT = "__gram", "__grams", "__rows", "__exact"

#: What a regular expression is made of, in the order in which it is taken out. A full stop stands for
#: what was there and ends a run; a star also takes away the character before it.
_SIMPLIFIED = (
    (r"\\[dDwWsSbB.$^*+?()\[\]{}|/\-\\]", "."),
    (r"\[[^\[\]]+\]", "."),
    (r"\([^()]*\)", "."),
    (r"\([^()]*\)", "."),
    (r"\([^()]*\)", "."),
    (r"\{[0-9,]+\}", "*"),
)
_PLAIN = r"[^.^$*+?{}()\[\]|\\]"
_ONE = r"(?:\.|\[[^\[\]\\]+\])"  # exactly one character
#: A run with what stands for single characters between it and the start or the end of the text.
_AT_START = {"like": r"(?s)^(_*)([^%_]+)", "regexpLike": rf"(?s)^\^({_ONE}*)((?:{_PLAIN}(?![*?{{]))+)"}
_AT_END = {"like": r"(?s)([^%_]+)(_*)$", "regexpLike": rf"(?s)(?<!\\)((?:{_PLAIN})+)({_ONE}*)\$$"}
#: ``$`` also matches before a line break that ends the text.
_LAST_BREAK = "(?:\r\n|[\n\r\u0085\u2028\u2029])\\z"


@dataclass(frozen=True)
class Keyed:
    """Items with the key under which rows find them, and the items that have none."""

    keyed: DataFrame
    rest: Bound


def pattern_match(conditions: Sequence[Condition], combine: str) -> int | None:
    """The condition whose patterns lead to the rows: all conditions hold together, and this one is a
    ``like`` or ``regexpLike`` with a value of the item."""
    if combine != "AND" and len(conditions) > 1:
        return None
    for position, condition in enumerate(conditions):
        if condition.uses_item and condition.operator in ("like", "regexpLike"):
            return position
    return None


def grams(text: Column) -> Column:
    """The distinct grams of a text: one scan, whatever its length."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(rf"(?s)(?=(.{{{GRAM}}}))"), F.lit(1)))


def literal_runs(operator: str, pattern: Column) -> Column:
    """Texts that whatever matches the pattern holds; none where that is not sure."""
    none = F.array().cast("array<string>")
    if operator == "like":
        runs = F.regexp_extract_all(pattern, F.lit("(?s)[^%_]+"), F.lit(0))
        return F.when(_unsure(operator, pattern), none).otherwise(runs)
    # A character that may be missing is no part of a run.
    runs = F.regexp_extract_all(_simplified(pattern), F.lit(rf"(?:{_PLAIN}(?![*?]))+"), F.lit(0))
    return F.when(_unsure(operator, pattern), none).otherwise(runs)


def _simplified(pattern: Column) -> Column:
    for found, instead in _SIMPLIFIED:
        pattern = F.regexp_replace(pattern, F.lit(found), F.lit(instead))
    return pattern


def _unsure(operator: str, pattern: Column) -> Column:
    if operator == "like":
        return pattern.contains("\\")
    return pattern.contains("(?") | _simplified(pattern).rlike(r"[\\|()\[\]{}]")


def _fragments(items: DataFrame, operator: str, given: str) -> DataFrame:
    """Adds ``__grams``, what whatever matches a pattern offers: runs in fixed places, as ``<2:run`` two
    characters after the start and ``>2:run`` two before the end, and grams of the other runs; and ``__exact``,
    whether whatever offers its one fragment matches the pattern."""
    names = items.columns
    pattern, runs, keys = F.col(given), F.col("__runs"), []
    items = items.withColumn("__runs", literal_runs(operator, pattern))
    for side, found, run_at in (("<", _AT_START, 2), (">", _AT_END, 1)):
        run, between = (F.regexp_extract(pattern, found[operator], k) for k in (run_at, 3 - run_at))
        away = F.char_length(F.regexp_replace(between, _ONE, "_"))
        items = items.withColumns({"__run": run, "__away": away})
        run, away = F.col("__run"), F.col("__away")
        fixed = (F.size(runs) > 0) & (F.char_length(run) > 0) & (away <= FARTHEST)
        cut = F.substring(run, 1, LONGEST) if side == "<" else F.right(run, F.lit(LONGEST))
        key = F.when(fixed, F.concat(F.lit(side), away.cast("string"), F.lit(":"), cut))
        # The grams of a run that is there as a whole are held by as many rows or more.
        whole = F.when(fixed & (F.char_length(run) <= LONGEST), run).alias(f"__whole{side}")
        items = items.select(*[c for c in items.columns if c not in ("__run", "__away")], key.alias(f"__key{side}"), whole)
        keys.append(f"__key{side}")
    rest = F.array_except(runs, F.array("__whole<", "__whole>"))
    items = items.withColumn("__runs", F.flatten(F.transform(rest, grams)))
    own = F.array_except(F.concat(F.array(*keys), "__runs"), F.array(F.lit(None).cast("string")))
    exact = F.lit(False)
    if operator == "like":
        run, away = f"[^%_]{{1,{LONGEST}}}", f"_{{0,{FARTHEST}}}"
        exact = pattern.rlike(f"(?s)\\A(?:%{run}{away}|{away}{run}%)\\z") & ~_unsure(operator, pattern)
    own = F.coalesce(own, F.array().cast("array<string>")).alias(_GRAMS)
    return items.select(*names, own, F.coalesce(exact, F.lit(False)).alias(_EXACT))


def _shapes(keys: DataFrame) -> list[str]:
    """The shapes of the fragments in column ``__gram``: ``gram``, or side, distance and length."""
    length = F.char_length(_GRAM) - F.instr(_GRAM, ":")
    fixed = F.concat(F.substring_index(_GRAM, ":", 1), F.lit(":"), length.cast("string"))
    shape = F.when(F.char_length(_GRAM) == GRAM, F.lit("gram")).otherwise(fixed)
    return sorted(row.shape for row in keys.select(shape.alias("shape")).distinct().collect())


def _offered(text: Column, operator: str, shapes: Sequence[str]) -> Column:
    """A text's distinct fragments of the given shapes."""
    found = []
    ends = [text]
    if operator == "regexpLike":
        ends.append(F.regexp_replace(text, F.lit(_LAST_BREAK), F.lit("")))
    for shape in shapes:
        if shape == "gram":
            continue
        away, length = map(int, shape[1:].split(":"))
        for own in ends if shape[0] == ">" else [text]:
            size = F.char_length(own)
            first = F.lit(away + 1) if shape[0] == "<" else size - (away + length - 1)
            piece = F.concat(F.lit(f"{shape[0]}{away}:"), F.substring(own, first, F.lit(length)))
            found.append(F.when(size >= away + length, piece))
    fixed = F.array(*found).cast("array<string>")
    offered = F.concat(fixed, grams(text)) if "gram" in shapes else fixed
    return F.array_except(offered, F.array(F.lit(None).cast("string")))


def _text(df: DataFrame, condition: Condition) -> Column:
    text = col(condition.column)
    return text if is_text(df.schema[condition.column].dataType) else text.cast("string")


def keyed_items(df: DataFrame, bound: Bound, conditions: Sequence[Condition], position: int) -> Keyed:
    """Find every pattern's key. Reads the pattern's column of the table once, to count, if a pattern has a choice."""
    condition = conditions[position]
    items = pinned(_fragments(bound.valid, condition.operator, f"__w{position}"))
    rest = replace(bound, valid=items.where(F.size(_GRAMS) == 0).drop(_GRAMS, _EXACT))
    single = items.where(F.size(_GRAMS) == 1).withColumn(_GRAM, F.get(_GRAMS, F.lit(0))).drop(_GRAMS)
    several = items.where(F.size(_GRAMS) > 1)
    if several.isEmpty():
        return Keyed(pinned(single), rest)
    offered = several.select(ITEM, F.explode(_GRAMS).alias(_GRAM))
    wanted = offered.select(_GRAM).distinct()
    small = fits_broadcast(wanted)
    held = df.select(F.explode(_offered(_text(df, condition), condition.operator, _shapes(offered))).alias(_GRAM))
    held = held.join(F.broadcast(wanted), _GRAM, "left_semi") if small else held
    counts = held.groupBy(_GRAM).agg(F.count("*").alias(_ROWS))
    # A gram that no row holds isn't counted: it stays the key, and leads nowhere.
    counted = offered.join(counts, _GRAM, "left").select(ITEM, _GRAM, F.coalesce(_ROWS, F.lit(0)).alias(_ROWS))
    best = counted.groupBy(ITEM).agg(F.min(F.struct(_ROWS, _GRAM)).alias("best"))
    best = best.where(F.col("best")[_ROWS] > 0).select(ITEM, F.col("best")[_GRAM].alias(_GRAM))
    return Keyed(pinned(several.drop(_GRAMS).join(best, ITEM).unionByName(single)), rest)


def _met(df: DataFrame, keyed: DataFrame, conditions: Sequence[Condition], position: int) -> DataFrame:
    """Rows of ``df`` with ``__item`` of every keyed item that matches them."""
    names = [col(name) for name in df.columns]
    offered = _offered(_text(df, conditions[position]), conditions[position].operator, _shapes(keyed))
    rows = df.select("*", F.explode(offered).alias(_GRAM))
    small = fits_broadcast(keyed)
    if not small:
        # Grams that are no item's key don't reach the shuffle, if the keys are few.
        keys = keyed.select(_GRAM).distinct()
        rows = rows.join(F.broadcast(keys), _GRAM, "left_semi") if fits_broadcast(keys) else rows

    def given(i):
        return F.col(f"__w{i}")

    test = predicate(df.schema, [conditions[position]], "AND", item_value=lambda _: given(position))
    test = F.col(_EXACT) | test
    others = [i for i in range(len(conditions)) if i != position]
    if others:
        test = test & predicate(df.schema, [conditions[i] for i in others], "AND", item_value=lambda k: given(others[k]))
    return rows.join(join_side(keyed, small), _GRAM).where(test).select(ITEM, *names)


def select_by_patterns(
    df: DataFrame, keyed: DataFrame, conditions: Sequence[Condition], position: int
) -> DataFrame:
    """Every row with every keyed item that asks for it: ``item`` and the columns of ``df``."""
    found = _met(df, keyed, conditions, position)
    return found.select(F.col(ITEM).alias("item"), *[col(name) for name in df.columns])


def first_by_patterns(
    df: DataFrame, keyed: DataFrame, conditions: Sequence[Condition], position: int, first: str
) -> DataFrame:
    """All rows with the first keyed item that matches each.

    Rows that are equal in the columns of the conditions have the same first item, so it is looked for once per
    distinct value of them.
    """
    names = list(dict.fromkeys(condition.column for condition in conditions))
    met = _met(df.select(*[col(name) for name in names]).distinct(), keyed, conditions, position)
    places = [f"__c{i}" for i in range(len(names))]
    least = met.groupBy(*[col(name).alias(place) for name, place in zip(names, places, strict=True)])
    least = pinned(least.agg(F.min(ITEM).alias(first)))
    same = F.lit(True)
    for name, place in zip(names, places, strict=True):
        same = same & col(name).eqNullSafe(F.col(place))
    side = join_side(least, fits_broadcast(least))
    return df.join(side, same, "left").drop(*places)
