"""Items that ask for text by patterns: fragments against plain loops, odd patterns, many items."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from tablesmith import Condition, FromItem, Items
from tablesmith.operators import patterns
from tablesmith.operators.delete import delete_per_item
from tablesmith.operators.select import select_per_item
from tablesmith.sources.items import bind_items

WORDS = ["amber", "birch", "cedar", "ambrosia", "xbircha", "a.b", "a(b", "😀pine", "", None]
LIKES = ["amb%", "%irch%", "_edar", "%", "am_er", "ce%ar", "%ines", "%pine", "a\\_b%", None, "%zzz%"]
REGULAR = [
    "amb", "^birch$", "ambe?r", "ce[dt]ar", "x?birch", "amber|cedar", "(amb|bir)(er|ch)", "(?i)AMBER",
    r"a\.b", r"a\(b", "cedar{1,2}", "birch+a*", "bir.h", ".*", "a.b", r"\bpine", "[^a]irch", "birc{1}ha", r"\Qa.b\E", None,
    "cedarx*", "(xb)?irch", "pine{0}", "a+mb++", "(a(m(b)))er",
]


def like(pattern, text):
    escaped = pattern.replace("\\_", "\0")
    parts = [".*" if c == "%" else "." if c == "_" else "_" if c == "\0" else re.escape(c) for c in escaped]
    return re.fullmatch("".join(parts), text, re.DOTALL) is not None


def regular(pattern, text):
    pattern = r"a\.b" if pattern == r"\Qa.b\E" else pattern
    return re.search(pattern, text) is not None


CASES = [("like", LIKES, like), ("regexpLike", REGULAR, regular)]


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize(("name", "pool", "holds"), CASES, ids=["like", "regexp"])
def test_patterns_equal_single_statements(spark, monkeypatch, name, pool, holds, broadcast):
    if not broadcast:
        monkeypatch.setattr(patterns, "fits_broadcast", lambda df: False)
    rng = random.Random(3)
    rows = [(i, None if (w := rng.choice(WORDS)) is None else " ".join([w, rng.choice(["", "cedar", "pines"])]).strip()) for i in range(60)]
    items = [(5 * i - 9, pattern, rng.choice([20, 60])) for i, pattern in enumerate(pool * 2)]
    df = spark.createDataFrame(rows, "id int, s string")
    batch = Items(spark.createDataFrame(items, "item long, p string, top int"))
    where = [Condition("s", name, FromItem("p")), Condition("id", "notEquals", FromItem("top"))]

    def matches(item, row):
        return row[1] is not None and item[1] is not None and holds(item[1], row[1]) and row[0] != item[2]

    found, _ = select_per_item(df, batch, where)
    expected = [(item[0], *row) for item in items for row in rows if matches(item, row)]
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, expected))

    change = delete_per_item(df, batch, where)
    left, counts = list(rows), {}
    for item in items:
        hit = [row for row in left if matches(item, row)]
        counts[item[0]] = len(hit)
        left = [row for row in left if row not in hit]
    assert sorted(map(repr, map(tuple, change.image.collect()))) == sorted(map(repr, left))
    assert {r.item: r.affectedRows for r in change.outcome.collect()} == counts


def test_runs_are_held_by_every_match(spark):
    df = spark.createDataFrame([(p,) for p in REGULAR if p], "p string")
    runs = {r.p: r.runs for r in df.select("p", patterns.literal_runs("regexpLike", F.col("p")).alias("runs")).collect()}
    for pattern, found in runs.items():
        for text in [w for w in WORDS if w]:
            if regular(pattern, text):
                assert all(run in text for run in found), pattern
    assert runs["ambe?r"] == ["amb", "r"]
    assert runs["amber|cedar"] == runs["(?i)AMBER"] == runs[r"\Qa.b\E"] == []
    assert runs["birc{1}ha"] == ["bir", "ha"]


def test_many_patterns_take_few_jobs_and_no_slices(spark):
    """40,000 patterns: rows meet only those whose rarest fragment they hold."""
    df = spark.range(2000).select("id", F.concat(F.lit("order number "), F.col("id").cast("string"), F.lit(" of many")).alias("s"))
    batch = Items(spark.range(40000).select(F.col("id").alias("item"), F.concat(F.lit("%number "), F.col("id").cast("string"), F.lit(" of%")).alias("p")))
    found, _ = select_per_item(df, batch, [Condition("s", "like", FromItem("p"))])
    assert found.where("item = id").count() == found.count() == 2000
    plan = found._jdf.queryExecution().analyzed().toString()
    assert "__items" not in plan


def test_no_rows_and_no_items(spark):
    df = spark.createDataFrame([], "id int, s string")
    where = [Condition("s", "regexpLike", FromItem("p"))]
    batch = Items(spark.createDataFrame([(1, "birch")], "item long, p string"))
    assert select_per_item(df, batch, where)[0].count() == 0
    none = Items(spark.createDataFrame([], "item long, p string"))
    assert select_per_item(spark.createDataFrame([(1, "birch")], df.schema), none, where)[0].count() == 0
    change = delete_per_item(spark.createDataFrame([(1, "birch")], df.schema), none, where)
    assert change.image.count() == 1


FIXED = {
    "like": ["7%", "%7_", "__3%", "%12", "_", "%5__", "9%1", "%1%", "12_45%", "%9999999999999999999"],
    "regexpLike": ["^7", "7[05]$", "^..3", "12$", "^.$", "5..$", "^9.*1$", "^12*$", "^1?2$", "1+$", "7.?$", r"\d2$", "(1|2)3$", "x5$|3$"],
}


@pytest.mark.parametrize("name", ["like", "regexpLike"])
def test_short_runs_in_fixed_places_are_keys(spark, name):
    rng = random.Random(5)
    numbers = [rng.randrange(10 ** rng.randint(1, 7)) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(numbers)), "id int, n long")
    items = list(enumerate(FIXED[name]))
    where = [Condition("n", name, FromItem("p"))]
    found, _ = select_per_item(df, Items(spark.createDataFrame(items, "item long, p string")), where)
    holds = like if name == "like" else regular
    expected = [(i, *row) for i, p in items for row in enumerate(numbers) if holds(p, str(row[1]))]
    assert sorted(map(tuple, found.collect())) == sorted(expected)


def test_runs_before_a_last_line_break(spark):
    rows = [(i, f"x12{end}") for i, end in enumerate(["", "\n", "\r\n", "\u2028", "\n\n", " "])]
    df = spark.createDataFrame(rows, "id int, s string")
    items = Items(spark.createDataFrame([(0, "12$")], "item long, p string"))
    found, _ = select_per_item(df, items, [Condition("s", "regexpLike", FromItem("p"))])
    assert sorted(r.id for r in found.collect()) == sorted(r.id for r in df.where("s rlike '12$'").collect())


def test_keys_in_fixed_places_meet_little_more_than_they_match(spark):
    """Every row once met all patterns that shared one of its grams, and tried the short ones."""
    df = spark.range(20_000).select(F.col("id").alias("n"))
    parts = spark.range(3_000).select(F.col("id").alias("item"), F.concat(F.lit("%"), F.col("id").cast("string"), F.lit("_")).alias("p"))
    where = [Condition("n", "like", FromItem("p"))]
    bound = bind_items(Items(parts), df.schema, where)
    keyed = patterns.keyed_items(df, bound, where, 0)
    assert keyed.rest.valid.isEmpty() and keyed.keyed.count() == 3_000
    keys = keyed.keyed.select(patterns._GRAM)
    offered = df.select(F.explode(patterns._offered(F.col("n").cast("string"), "like", patterns._shapes(keys))).alias(patterns._GRAM))
    met = offered.join(keys, patterns._GRAM).count()
    assert met == patterns.select_by_patterns(df, keyed.keyed, where, 0).count()
