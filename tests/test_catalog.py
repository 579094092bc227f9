import pytest
from pyspark.sql import functions as F

from tablesmith import TableOperationError
from tablesmith.functions.text import (
    create_sql_functions,
    cut_middle,
    factorial,
    fibonacci,
    weighted_length,
)
from tablesmith.sources.catalog import (
    CONSTRAINT_COLUMNS,
    comment_on_schema,
    data_dictionary,
    describe_table,
    describe_tables,
    grouped_constraints,
    list_schemas,
    list_tables,
    list_tables_of,
    schema_names,
    table_names,
    write_schema,
)


def test_schemas(spark, ski):
    comment_on_schema(spark, ski, "it's a schema")
    found = {row.name: row.comment for row in list_schemas(spark).collect()}
    assert found[ski] == "it's a schema" and "default" in found
    names = [row.name for row in schema_names(spark).collect()]
    assert names == sorted(names)


def test_tables(spark, ski):
    tables = list_tables(spark, f" {ski} ").collect()
    assert [row.name for row in tables] == ["COMPETITIONS", "SKI_RESORT", "SKI_RUN"]
    assert {row.type for row in tables} == {"TABLE"} and {row.schema for row in tables} == {ski}
    assert tables[0].comment == "information about competitions" and tables[2].comment is None
    both = list_tables(spark, ski, include_views=True).collect()
    assert [(row.name, row.type) for row in both] == [
        ("COMPETITIONS", "TABLE"),
        ("DIFFICULT_RUN", "VIEW"),
        ("HIGH_ALTITUDE_RESORT", "VIEW"),
        ("SKI_RESORT", "TABLE"),
        ("SKI_RUN", "TABLE"),
    ]
    assert both[1].comment == "all known black runs"
    with pytest.raises(TableOperationError, match="Schema must not be empty"):
        list_tables(spark, " ")


def test_names_to_choose_from(spark, ski):
    assert table_names(spark, None).isEmpty() and table_names(spark, "").isEmpty()
    assert table_names(spark, ski).count() == 3
    assert table_names(spark, ski, include_views=True).count() == 5


def test_describe_columns(operations, ski):
    columns, constraints = describe_table(operations.store, ski, "SKI_RESORT")
    found = [tuple(row) for row in columns.collect()]
    assert found[0] == ("RESORT_ID", "DECIMAL(18,0)", False, None, "the ski resort id")
    assert found[1] == ("RESORT_NAME", "VARCHAR(1000)", True, None, None)
    assert [row[0] for row in found] == ["RESORT_ID", "RESORT_NAME", "COUNTRY", "ALTITUDE"]
    assert [(r.type, r.name, r.columns) for r in constraints.collect()] == [
        ("PRIMARY KEY", "SKI_RESORT_PK", ["RESORT_ID"])
    ]


def test_describe_keys(operations, ski):
    _, constraints = describe_table(operations.store, ski, "SKI_RUN")
    found = {row.name: row for row in constraints.collect()}
    assert found["SKI_RUN_PK"].columns == ["RESORT_ID", "RUN_NAME"]
    assert found["SKI_RUN_PK"].referencedTable is None and found["SKI_RUN_PK"].referencedColumns == []
    assert found["RESORT_FK"].referencedTable == "SKI_RESORT"
    _, constraints = describe_table(operations.store, ski, "COMPETITIONS")
    (foreign,) = constraints.collect()
    assert list(zip(foreign.columns, foreign.referencedColumns)) == [
        ("RESORT_ID", "RESORT_ID"),
        ("COMPETITION_RUN", "RUN_NAME"),
    ]


def test_describe_view_and_unknown(operations, ski):
    columns, constraints = describe_table(operations.store, ski, "DIFFICULT_RUN")
    assert columns.count() == 4 and constraints.isEmpty()
    columns, constraints = describe_table(operations.store, ski, "NO_SUCH_TABLE")
    assert columns.isEmpty() and constraints.isEmpty()
    with pytest.raises(TableOperationError, match="Table must not be empty"):
        describe_table(operations.store, ski, None)


def test_defaults_are_described(operations, schema):
    operations.store.create(schema, "D", "A INT DEFAULT 5, B STRING COMMENT 'the b'")
    columns, _ = describe_table(operations.store, schema, "D")
    assert [(r.name, r.default, r.comment) for r in columns.collect()] == [("A", "5", None), ("B", None, "the b")]


def test_grouping_constraint_rows(spark):
    rows = [
        ("FOREIGN KEY", "FK", "B", 1, "S", "T", "Y"),
        ("PRIMARY KEY", "SYS_123", "A", 0, None, None, None),
        ("FOREIGN KEY", "FK", "A", 0, "S", "T", "X"),
        ("PRIMARY KEY", "SYS_124", "B", 0, None, None, None),
    ]
    found = [tuple(row) for row in grouped_constraints(spark.createDataFrame(rows, CONSTRAINT_COLUMNS)).collect()]
    assert found == [
        ("FOREIGN KEY", "FK", ["A", "B"], "S", "T", ["X", "Y"]),
        ("PRIMARY KEY", None, ["A"], None, None, []),
        ("PRIMARY KEY", None, ["B"], None, None, []),
    ]


def test_data_dictionary(operations, ski):
    columns, constraints = data_dictionary(operations.store, ski)
    assert columns.count() == 4 * 5
    assert columns.select("table").distinct().count() == 5
    assert [(r.table, r.name) for r in constraints.collect()] == [
        ("COMPETITIONS", "COMPETITION_FK"),
        ("SKI_RESORT", "SKI_RESORT_PK"),
        ("SKI_RUN", "RESORT_FK"),
        ("SKI_RUN", "SKI_RUN_PK"),
    ]


def test_several_requests(spark, operations, ski):
    found, errors = list_tables_of(spark, [ski, "", "no_such_schema", ski], continue_on_fail=True)
    assert [row.item for row in found.collect()] == [0, 0, 0, 3, 3, 3]
    assert [row.item for row in errors.collect()] == [1]
    requests = [(ski, "SKI_RUN"), (ski, " "), (ski, "NO_SUCH_TABLE"), (ski, "COMPETITIONS")]
    columns, keys, errors = describe_tables(operations.store, requests, continue_on_fail=True)
    assert [row.item for row in columns.collect()] == [0] * 4 + [3] * 4
    assert [(row.item, row.name) for row in keys.collect()] == [
        (0, "RESORT_FK"),
        (0, "SKI_RUN_PK"),
        (3, "COMPETITION_FK"),
    ]
    assert [row.item for row in errors.collect()] == [1]
    with pytest.raises(TableOperationError) as caught:
        describe_tables(operations.store, requests)
    assert caught.value.item == 1


def test_write_schema(spark):
    assert write_schema(spark) == "default"


# -- functions -------------------------------------------------------------------------------------


def test_cut_middle(spark):
    cases = [("abcdef", 2, 5, "abef"), ("abcdef", 0, 5, "abcdef"), ("abcdef", 3, 3, "abcdef"), ("ab", 3, 5, "ab"), (None, 1, 2, None)]
    df = spark.createDataFrame(cases, "t string, a int, b int, expected string")
    create_sql_functions(spark)
    for result in (cut_middle(F.col("t"), F.col("a"), F.col("b")), F.expr("cut_middle(t, a, b)")):
        assert [r[0] for r in df.select(result).collect()] == [c[3] for c in cases]


def test_factorial(spark):
    df = spark.createDataFrame([(-1, 1), (0, 1), (1, 1), (5, 120), (19, 121645100408832000)], "n int, f bigint")
    create_sql_functions(spark)
    assert df.where(factorial(F.col("n")) != F.col("f")).isEmpty()
    assert df.where(F.expr("factorial_of(n) != f")).isEmpty()
    with pytest.raises(Exception, match="overflow"):
        spark.range(1).select(factorial(F.lit(20))).collect()
    for large in (20, 21, 25):
        with pytest.raises(Exception, match="overflow"):
            spark.sql(f"SELECT factorial_of({large})").collect()


def test_fibonacci(spark):
    df = spark.createDataFrame([(0,), (1,), (7,), (-2,)], "n int")
    rows = df.select("n", F.explode(fibonacci(F.col("n"))).alias("f")).select("n", "f.*").collect()
    assert [(int(r.num), int(r.val)) for r in rows if r.n == 7] == list(enumerate([0, 1, 1, 2, 3, 5, 8]))
    assert [r.n for r in rows if r.n != 7] == [1]


def test_weighted_length(spark):
    df = spark.createDataFrame([("g", "abc", 2.0), ("g", "é", 0.5), ("h", "", 9.0)], "g string, t string, w double")
    found = df.groupBy("g").agg(weighted_length(F.col("t"), F.col("w")).alias("x")).collect()
    assert {r.g: r.x for r in found} == {"g": 6.5, "h": 0.0}
