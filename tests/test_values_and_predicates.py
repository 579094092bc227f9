import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from tablesmith import Condition, FromItem, SortRule, TableOperationError
from tablesmith.errors import require_text
from tablesmith.functions.ordering import positive_integer, sort_columns, top_n
from tablesmith.functions.predicates import OPERATORS, predicate
from tablesmith.functions.values import assignment_cast, assignment_literal, comparison_literal
from tablesmith.operators.select import limited, result_cap, select_rows, unique_names


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [
            (1, "Ann", Decimal("10.50"), 1.5, dt.date(2024, 1, 15), True),
            (2, "bob", Decimal("20.00"), 2.5, dt.date(2024, 2, 1), False),
            (3, None, None, None, None, None),
            (9007199254740993, "Zoe%", Decimal("0.01"), -1.0, dt.date(2023, 12, 31), True),
        ],
        "id bigint, name string, amount decimal(10,2), score double, born date, ok boolean",
    )


def ids(df):
    return [row.id for row in df.orderBy("id").collect()]


@pytest.mark.parametrize(
    "condition, expected",
    [
        (Condition("id", "equals", "1"), [1]),
        (Condition("id", "notEquals", 1), [2, 3, 9007199254740993]),
        (Condition("id", "lessThan", "2.5"), [1, 2]),
        (Condition("id", "equals", "1.5"), []),
        (Condition("id", "equals", "9007199254740992"), []),
        (Condition("id", "equals", "9007199254740993"), [9007199254740993]),
        (Condition("amount", "lessThanOrEqual", "10.5"), [1, 9007199254740993]),
        (Condition("amount", "equals", "10.505"), []),
        (Condition("amount", "greaterThan", 10.5), [2]),
        (Condition("amount", "greaterThanOrEqual", Decimal("10.50")), [1, 2]),
        (Condition("score", "greaterThan", "1"), [1, 2]),
        (Condition("name", "like", "A%"), [1]),
        (Condition("name", "notLike", "A%"), [2, 9007199254740993]),
        (Condition("name", "regexpLike", "^[A-Z]"), [1, 9007199254740993]),
        (Condition("name", "notRegexpLike", "^[A-Z]"), [2]),
        (Condition("name", "isNull", "whatever"), [3]),
        (Condition("name", "isNotNull"), [1, 2, 9007199254740993]),
        (Condition("name", "equals", None), []),
        (Condition("name", "equals", "ann"), []),
        (Condition("born", "lessThan", "2024-01-15"), [9007199254740993]),
        (Condition("born", "lessThan", "2024-01-15T00:00:01"), [1, 9007199254740993]),
        (Condition("ok", "equals", "true"), [1, 9007199254740993]),
        (Condition("id", "like", "9007%"), [9007199254740993]),
    ],
)
def test_each_operator(people, condition, expected):
    assert ids(select_rows(people, [condition])) == expected


def test_combinators(people):
    both = [Condition("id", "lessThan", 3), Condition("ok", "equals", True)]
    assert ids(select_rows(people, both)) == [1]
    assert ids(select_rows(people, both, "OR")) == [1, 2, 9007199254740993]
    assert ids(select_rows(people)) == [1, 2, 3, 9007199254740993]
    # With nothing to combine, the combinator is not looked at.
    assert predicate(people.schema, [], "XOR") is None


def test_regexp_searches_or_matches_all(people):
    search = [Condition("name", "regexpLike", "n")]
    assert ids(select_rows(people, search)) == [1]
    assert ids(select_rows(people, search, full_match=True)) == []


@pytest.mark.parametrize(
    "conditions, combine",
    [
        ([Condition("id", "like_", 1)], "AND"),
        ([Condition("id", "__proto__", 1)], "AND"),
        ([Condition("id", "equals", 1)], "XOR"),
        ([Condition("id", "equals", 1)], "and"),
        ([Condition("", "equals", 1)], "AND"),
        ([Condition("  ", "equals", 1)], "AND"),
        ([Condition(5, "equals", 1)], "AND"),
        ([Condition("ID", "equals", 1)], "AND"),
        ([Condition(" id", "equals", 1)], "AND"),
        ([Condition("id", "equals", "abc")], "AND"),
        ([Condition("score", "equals", float("nan"))], "AND"),
        ([Condition("score", "equals", float("inf"))], "AND"),
        ([Condition("name", "equals", ["a", "b"])], "AND"),
        ([Condition("born", "equals", "not a date")], "AND"),
        ([Condition("ok", "equals", "maybe")], "AND"),
        ([Condition("id", "equals", FromItem("x"))], "AND"),
    ],
)
def test_malformed_conditions_are_refused(people, conditions, combine):
    with pytest.raises(TableOperationError):
        select_rows(people, conditions, combine)


def test_every_operator_is_known():
    assert len(OPERATORS) == 12


def test_instants_are_utc(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-15 10:30:00.123' AS t")
    local = dt.datetime(2024, 1, 15, 12, 30, 0, 123000, dt.timezone(dt.timedelta(hours=2)))
    for value in (local, "2024-01-15T10:30:00.123Z", "2024-01-15 10:30:00.123"):
        assert select_rows(df, [Condition("t", "equals", value)]).count() == 1


def test_text_of_values(spark):
    def text(value):
        return spark.range(1).select(comparison_literal(value, T.StringType())).first()[0]

    assert text(5) == "5"
    assert text(True) == "true"
    assert text("it's") == "it's"
    assert text(dt.datetime(2024, 1, 15, 10, 30, 0, 123456)) == "2024-01-15 10:30:00.123"
    assert text(None) is None


def test_assignment_must_fit():
    for value, dtype in [
        ("1.5", T.IntegerType()),
        (2**31, T.IntegerType()),
        ("100000", T.DecimalType(5, 2)),
        ("x", T.DoubleType()),
    ]:
        with pytest.raises(TableOperationError):
            assignment_literal(value, dtype)


def test_assignment_cast(spark):
    df = spark.createDataFrame(
        [("7",), ("7.0",), ("7.5",), ("x",), (" 8 ",), (None,)], "v string"
    )
    cast = assignment_cast(F.col("v"), T.StringType(), T.IntegerType())
    assert [row[0] for row in df.select(cast).collect()] == [7, 7, None, None, 8, None]
    numbers = spark.createDataFrame([(1.0,), (1.5,)], "v double")
    cast = assignment_cast(F.col("v"), T.DoubleType(), T.IntegerType())
    assert [row[0] for row in numbers.select(cast).collect()] == [1, None]


def test_simple_filters_reach_the_scan(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    for condition, pushed in [
        (Condition("o_orderkey", "equals", "5"), "EqualTo(o_orderkey,5)"),
        (Condition("o_totalprice", "greaterThan", "10"), "GreaterThan(o_totalprice,10.0)"),
        (
            Condition("o_orderdate", "lessThan", "1999-01-01"),
            "LessThan(o_orderdate,1999-01-01T00:00)",
        ),
        (Condition("o_orderstatus", "like", "F%"), "StringStartsWith(o_orderstatus,F)"),
    ]:
        plan = select_rows(orders, [condition])._jdf.queryExecution().toString()
        assert pushed in plan


@pytest.mark.parametrize("value, expected", [(5, 5), ("10", 10), (3.0, 3), ("7.0", 7)])
def test_limits(value, expected):
    assert positive_integer(value) == expected


@pytest.mark.parametrize("value", [0, -1, 1.5, "abc", "", None, True, "1.5", float("nan"), [1]])
def test_bad_limits(value):
    with pytest.raises(TableOperationError, match="no positive integer"):
        positive_integer(value)


def test_limit_only_when_asked():
    assert limited() is None
    assert limited(True, "nonsense") is None
    assert limited(False) == 50
    assert limited(False, "3") == 3


def test_sort(people):
    ordered = select_rows(people, sort=[SortRule("amount", "DESC")])
    assert [row.id for row in ordered.collect()][-1] == 3
    first = select_rows(people, sort=[SortRule("amount", "DESC")], nulls="first")
    assert first.first().id == 3
    top = select_rows(people, sort=[SortRule("ok"), SortRule("id", "DESC")], limit=2)
    assert [row.id for row in top.collect()] == [2, 9007199254740993]


@pytest.mark.parametrize(
    "rule", [SortRule(""), SortRule("id", "asc"), SortRule("id", "DOWN"), SortRule("nope"), SortRule(3)]
)
def test_bad_sort(people, rule):
    with pytest.raises(TableOperationError):
        sort_columns(people.columns, [rule])


def test_sorted_limit_is_a_top_k(people):
    plan = select_rows(people, sort=[SortRule("id")], limit=3)._jdf.queryExecution().toString()
    assert "TakeOrderedAndProject" in plan


def test_top_n_per_group_both_ways(spark):
    df = spark.range(20000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    hot = df.unionByName(spark.range(10000).select(F.lit(0).cast("bigint").alias("g"), (F.col("id") + 20000).alias("v")))
    for n in (5, 1500):
        kept = top_n(hot, ["g"], [F.desc("v")], n)
        counts = {row.g: (row.n, row.low) for row in kept.groupBy("g").agg(F.count("*").alias("n"), F.min("v").alias("low")).collect()}
        assert {g: n_ for g, (n_, _) in counts.items()} == {0: n, 1: n, 2: n}
        assert counts[0][1] == 30000 - n


def test_result_cap(people):
    assert result_cap(people, 2).count() == 2
    assert result_cap(people, 0).count() == 4
    for bad in (-1, True, "5"):
        with pytest.raises(TableOperationError):
            result_cap(people, bad)


def test_repeated_names_last_value_first_position(spark):
    df = spark.sql("SELECT 1 AS a, 2 AS b, 3 AS a")
    result = unique_names(df)
    assert result.columns == ["a", "b"]
    assert tuple(result.first()) == (3, 2)


@pytest.mark.parametrize("value", ["", "   ", None, 5, []])
def test_required_text(value):
    with pytest.raises(TableOperationError, match="Schema must not be empty"):
        require_text(value, "Schema", 0)


def test_required_text_is_trimmed():
    assert require_text("  S ", "Schema") == "S"
