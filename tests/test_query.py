"""SQL text: results, guard, three modes, UPDATE / DELETE / MERGE."""

import pytest

from tablesmith import Query, SqlExecutor, TableOperationError
from tablesmith.functions.guard import (
    NOT_A_SELECT,
    PROHIBITED_WORDS,
    READ_ONLY,
    UNTERMINATED,
    lexical_verdicts,
    require_read_only,
)


@pytest.fixture
def sql(operations):
    return SqlExecutor(operations)


def write(sql, *queries, **options):
    return sql.execute(list(queries), read_only=False, **options)


def competitions(spark, schema):
    return spark.table(f"{schema}.COMPETITIONS").count()


def insert(schema, season=2024):
    return f"INSERT INTO {schema}.COMPETITIONS VALUES ('FIS WC', {season}, 1000, 'Christine')"


# -- guard -----------------------------------------------------------------------------------------

# A prohibited word counts where it stands alone outside quotes and comments, in any case, and nowhere
# else; a statement must also have the word that reads.
ACCEPTED = [
    "SELECT o_orderkey FROM orders WHERE o_totalprice > 10 ORDER BY 1",
    "\n\tsElEcT max(l_tax)\nFROM lineitem;  ",
    "WITH busy AS (SELECT o_custkey FROM orders) SELECT count(*) FROM busy JOIN customer ON o_custkey = c_custkey",
    "(SELECT n_name FROM nation) EXCEPT (SELECT r_name FROM region)",
    "SELECT '/* no comment', \"-- nor here\", `'` FROM part",
    "SELECT p_size -- it's only a note: \"\n, p_name /* `so` is this */ FROM part",
    *[
        form.format(word, word.lower())
        for word in PROHIBITED_WORDS
        for form in (
            "SELECT '{0} orders' FROM orders",
            "SELECT 'don''t {1} it' FROM orders",
            'SELECT "{0}" FROM orders',
            "SELECT `{1}` FROM orders",
            "SELECT 1 -- {0} orders",
            "SELECT 1 /* {1}\n{0} */ FROM orders",
            "SELECT {1}_at, {0}S, un{1} FROM orders",
        )
    ],
]
REJECTED = [
    "SHOW COLUMNS IN part",
    "'SELECT' -- SELECT",
    "SELECTED orders",
    "  \n",
    *[
        form.format(word, word.lower())
        for word in PROHIBITED_WORDS
        for form in (
            "{0} orders (SELECT 1)",
            "{1} orders",
            "SELECT o_orderkey FROM orders; {1} orders",
            "WITH few AS (SELECT 1) {0} orders",
            "SELECT o_orderkey {0} copy FROM orders",
            "SELECT 1 /* note */{1}/* note */ FROM orders",
            "SELECT 'x'{0}'y'",
        )
    ],
]
OPEN = [
    text + ending
    for text in ("SELECT n_name, ", "SELECT 'whole', ", "SELECT 1 /* whole */, ")
    for ending in ("'no end", '"no end', "`no end", "/* no end", "'no '' end", '"no "" end')
]


def test_lexical_guard_on_a_column_of_statements(spark):
    cases = [(s, READ_ONLY) for s in ACCEPTED] + [(s, NOT_A_SELECT) for s in REJECTED]
    cases += [(s, UNTERMINATED) for s in OPEN]
    cases.append(("SELECT '" + "x''\\'" * 60000 + "' FROM t", READ_ONLY))
    df = spark.createDataFrame(cases, "s string, expected string")
    wrong = lexical_verdicts(df, "s").where("verdict != expected")
    assert [row.s[:60] for row in wrong.collect()] == []


@pytest.mark.parametrize(
    "statement",
    [
        "WITH a AS (SELECT 'a\\'') INSERT INTO t SELECT * FROM a -- '",
        "CACHE TABLE x AS SELECT 1",
        "EXPLAIN SELECT 1",
        "SET VAR x = (SELECT 1)",
        "EXECUTE IMMEDIATE 'DROP TABLE t' USING (SELECT 1) AS a",
        "FROM t INSERT INTO a SELECT 1",
        "INSERT OVERWRITE DIRECTORY '/tmp/x' USING parquet SELECT 1",
        "SHOW TABLES",
    ],
)
def test_statements_that_are_more_than_a_read(spark, statement):
    with pytest.raises(Exception):
        require_read_only(spark, statement)


def test_parser_layer_alone_rejects_writes(spark):
    from tablesmith.functions.parsed import parse, writes_or_runs

    for statement, writes in [
        ("SELECT 1", False),
        ("WITH a AS (SELECT 1) SELECT * FROM a WHERE x IN (SELECT 2)", False),
        ("SELECT * FROM a UNION ALL SELECT * FROM b ORDER BY 1 LIMIT 3", False),
        ("WITH a AS (SELECT 1) INSERT INTO t SELECT * FROM a", True),
        ("FROM t INSERT INTO a SELECT 1 INSERT INTO b SELECT 2", True),
        ("CACHE TABLE x AS SELECT 1", True),
        ("EXPLAIN SELECT 1", True),
        ("CREATE TABLE t USING parquet AS SELECT 1", True),
        ("REPLACE TABLE t USING parquet AS SELECT 1", True),
        ("EXECUTE IMMEDIATE 'SELECT 1'", True),
        ("INSERT OVERWRITE DIRECTORY '/tmp/x' USING parquet SELECT 1", True),
        ("DELETE FROM t", True),
        ("UPDATE t SET a = 1", True),
        ("SET VAR x = (SELECT 1)", True),
    ]:
        assert writes_or_runs(spark, parse(spark, statement)) == writes, statement


def test_guard_blocks_writes_by_default(spark, sql, ski):
    for statement in (
        f"SELECT * INTO {ski}.X FROM {ski}.SKI_RUN",
        insert(ski),
        f"DELETE FROM {ski}.SKI_RUN",
    ):
        with pytest.raises(TableOperationError, match="more than a read"):
            sql.execute(statement)
    assert competitions(spark, ski) == 0 and spark.table(f"{ski}.SKI_RUN").count() == 7


# -- one statement ---------------------------------------------------------------------------------


def test_rows_carry_their_item(sql):
    (result,) = sql.execute("SELECT 1 AS N, 2 AS M, 3 AS N")
    assert result.rows.columns == ["item", "N", "M"]
    assert [tuple(row) for row in result.rows.collect()] == [(0, 3, 2)]


def test_common_table_expression(sql, ski):
    (result,) = sql.execute(
        f'WITH a AS (SELECT "RESORT_NAME" AS N FROM {ski}.SKI_RESORT WHERE "ALTITUDE" > 1000) '
        "SELECT N FROM a ORDER BY N"
    )
    assert [row.N for row in result.rows.collect()] == ["Courchevel", "Val Thorens"]


def test_parameters_are_positional(sql, ski):
    query = Query(
        f"SELECT RESORT_NAME FROM {ski}.SKI_RESORT WHERE ALTITUDE > ? AND COUNTRY = ?", [1900, "France"]
    )
    (result,) = sql.execute(query)
    assert [row.RESORT_NAME for row in result.rows.collect()] == ["Val Thorens"]


def test_result_cap(operations):
    many = "SELECT id FROM range(3000) ORDER BY id"
    (result,) = SqlExecutor(operations).execute(many)
    assert result.rows.count() == 3000 and not result.more
    (result,) = SqlExecutor(operations, cap=1000).execute(many)
    assert result.rows.count() == 1000 and result.more
    (result,) = SqlExecutor(operations, cap=3000).execute(many)
    assert result.rows.count() == 3000 and not result.more


def test_create_or_replace_table(spark, sql, schema):
    write(sql, f"CREATE TABLE {schema}.R (X INT) USING parquet", f"INSERT INTO {schema}.R VALUES (1)")
    write(sql, f"CREATE OR REPLACE TABLE {schema}.R (Y STRING) USING parquet")
    assert spark.table(f"{schema}.R").columns == ["Y"] and spark.table(f"{schema}.R").isEmpty()


def test_only_tables_are_created_in_a_transaction(sql, schema):
    with pytest.raises(TableOperationError, match="Only tables"):
        sql.execute([f"CREATE VIEW {schema}.V AS SELECT 1 AS x"], mode="transaction", read_only=False)


@pytest.mark.parametrize("text", ["", "   ", None])
def test_empty_query(sql, text):
    with pytest.raises(TableOperationError, match="must not be empty") as caught:
        sql.execute(["SELECT 1", Query(text)])
    assert caught.value.item == 1


def test_insert_counts(spark, sql, ski):
    statement = f"INSERT INTO {ski}.COMPETITIONS VALUES (?, ?, ?, ?)"
    results = write(sql, insert(ski), Query(statement, ["X", 2025, 1000, "Christine"]))
    assert [r.affected_rows for r in results] == [1, 1]
    (result,) = write(sql, f"INSERT INTO {ski}.SKI_RUN SELECT * FROM {ski}.SKI_RUN WHERE RUN_LENGTH > 1000")
    assert result.affected_rows == 4
    (result,) = write(sql, f"WITH a AS (SELECT 'Y', 1, 1, 'r') INSERT INTO {ski}.COMPETITIONS SELECT * FROM a")
    assert result.affected_rows == 1 and competitions(spark, ski) == 3


def test_delete_and_update_text(spark, sql, ski):
    write(sql, insert(ski), insert(ski, 2025))
    results = write(
        sql,
        f"DELETE FROM {ski}.COMPETITIONS WHERE SEASON = 2025",
        Query(f"UPDATE {ski}.SKI_RUN AS r SET RUN_LENGTH = r.RUN_LENGTH + ?, DIFFICULTY = upper(DIFFICULTY) WHERE RUN_LENGTH < ?", [5, 900]),
        Query(f"DELETE FROM {ski}.SKI_RUN WHERE RESORT_ID IN (SELECT RESORT_ID FROM {ski}.SKI_RESORT WHERE COUNTRY = ?)", ["Austria"]),
        f"UPDATE {ski}.SKI_RESORT SET ALTITUDE = NULL",
        f"DELETE FROM {ski}.COMPETITIONS",
    )
    assert [r.affected_rows for r in results] == [1, 2, 3, 3, 1]
    runs = spark.table(f"{ski}.SKI_RUN").where("RUN_LENGTH < 900").collect()
    assert [(r.RUN_NAME, r.DIFFICULTY, int(r.RUN_LENGTH)) for r in runs] == [("Chanrossa", "BLACK", 805)]
    assert competitions(spark, ski) == 0


def test_merge_text(spark, sql, ski):
    source = "(SELECT * FROM VALUES (1000, 'Z', 1), (1009, 'New', 2) AS v(id, name, alt))"
    merge = (
        f"MERGE INTO {ski}.SKI_RESORT target USING {source} src ON target.RESORT_ID = src.id "
        "WHEN MATCHED THEN UPDATE SET target.RESORT_NAME = src.name, target.ALTITUDE = src.alt "
        "WHEN NOT MATCHED THEN INSERT (RESORT_ID, RESORT_NAME, ALTITUDE) VALUES (src.id, src.name, src.alt)"
    )
    (result,) = write(sql, merge)
    assert result.affected_rows == 2
    found = {int(r.RESORT_ID): (r.RESORT_NAME, r.COUNTRY, int(r.ALTITUDE)) for r in spark.table(f"{ski}.SKI_RESORT").collect()}
    assert found[1000] == ("Z", "France", 1) and found[1009] == ("New", None, 2) and len(found) == 4
    only_new = (
        f"MERGE INTO {ski}.SKI_RESORT t USING {source} s ON t.RESORT_ID = s.id "
        "WHEN NOT MATCHED THEN INSERT (RESORT_ID, RESORT_NAME) VALUES (s.id, s.name)"
    )
    assert write(sql, only_new)[0].affected_rows == 0
    with pytest.raises(TableOperationError, match="MERGE"):
        write(sql, only_new.replace("t.RESORT_ID = s.id", "t.RESORT_ID > s.id"))


def test_merge_with_conditions_parameters_and_with(spark, sql, ski):
    resorts = f"{ski}.SKI_RESORT"
    start = {int(r.RESORT_ID): int(r.ALTITUDE) for r in spark.table(resorts).collect()}
    low, high = min(start, key=start.get), max(start, key=start.get)
    merge = (
        f"WITH given AS (SELECT * FROM VALUES ({low}, 1), ({high}, 2), (77, 3), (78, -3), (79, 4) AS v(id, n)) "
        f"MERGE INTO {resorts} AS t USING given s ON t.RESORT_ID = s.id AND s.n < ? "
        "WHEN MATCHED AND t.ALTITUDE = ? THEN DELETE "
        "WHEN MATCHED THEN UPDATE SET ALTITUDE = t.ALTITUDE + s.n + ?, RESORT_NAME = 'a ? -- b' "
        "WHEN NOT MATCHED AND s.n > ? THEN INSERT (RESORT_ID, ALTITUDE) VALUES (s.id, s.n)"
    )
    (result,) = write(sql, Query(merge, [100, start[high], 1000, 0]))
    assert result.affected_rows == 4
    found = {r.RESORT_ID: r for r in spark.table(resorts).collect()}
    assert set(found) == {*start, 77, 79} - {high}
    assert int(found[low].ALTITUDE) == start[low] + 1001 and found[low].RESORT_NAME == "a ? -- b"
    assert found[77].RESORT_NAME is None and int(found[79].ALTITUDE) == 4

    def of(actions, source=f"VALUES ({low}, 5), ({low}, 6)"):
        return f"MERGE INTO {resorts} t USING (SELECT * FROM {source} AS v(id, n)) s ON t.RESORT_ID = s.id {actions}"

    # Two source rows for one row of the table are refused only if both change it.
    with pytest.raises(TableOperationError, match="more than one source row"):
        write(sql, of("WHEN MATCHED AND s.n > 1 THEN UPDATE SET ALTITUDE = s.n"))
    before = spark.table(resorts).count()
    assert write(sql, of("WHEN MATCHED AND s.n > 5 THEN UPDATE SET ALTITUDE = s.n"))[0].affected_rows == 1
    assert spark.table(resorts).count() == before
    assert int(spark.table(resorts).where(f"RESORT_ID = {low}").first().ALTITUDE) == 6
    # A branch's values are computed only where it is taken.
    zero = of("WHEN MATCHED AND s.n <> 0 THEN UPDATE SET ALTITUDE = 6 div s.n WHEN MATCHED THEN DELETE", f"VALUES ({low}, 0)")
    assert write(sql, zero)[0].affected_rows == 1
    assert write(sql, of("WHEN NOT MATCHED BY SOURCE AND t.RESORT_ID = 79 THEN DELETE"))[0].affected_rows == 1
    assert write(sql, of("WHEN NOT MATCHED BY SOURCE AND t.RESORT_ID = -1 THEN DELETE"))[0].affected_rows == 0
    with pytest.raises(TableOperationError, match="Unknown column"):
        write(sql, of("WHEN MATCHED AND true THEN UPDATE SET NOTHING = 1"))


def test_merge_rewrites_only_what_it_matches(spark, operations, sql, schema):
    operations.store.create(schema, "DAYS", "ID INT, N INT, DAY INT", partitioned_by=["DAY"])
    spark.sql(f"INSERT INTO {schema}.DAYS VALUES (1, 10, 1), (2, 20, 2), (3, 30, 3), (4, 40, 4)")
    before = set(spark.table(f"{schema}.DAYS").inputFiles())
    # Row 2 is matched but not changed: its source row must not become a new row.
    merge = (
        f"MERGE INTO {schema}.DAYS t USING (SELECT * FROM VALUES (1, 5), (2, 0), (9, 9) AS v(id, n)) s ON t.ID = s.id "
        "WHEN MATCHED AND s.n > 0 THEN UPDATE SET N = s.n WHEN NOT MATCHED THEN INSERT (ID, N, DAY) VALUES (s.id, s.n, 3)"
    )
    assert write(sql, merge)[0].affected_rows == 2
    found = sorted(tuple(r) for r in spark.table(f"{schema}.DAYS").collect())
    assert found == [(1, 5, 1), (2, 20, 2), (3, 30, 3), (4, 40, 4), (9, 9, 3)]
    assert len(before & set(spark.table(f"{schema}.DAYS").inputFiles())) == 1
    star = (
        f"MERGE INTO {schema}.DAYS t USING (SELECT 4 AS ID, 44 AS N, 7 AS DAY) s ON t.ID = s.ID "
        "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )
    assert write(sql, star)[0].affected_rows == 1
    assert sorted(tuple(r) for r in spark.table(f"{schema}.DAYS").where("ID = 4").collect()) == [(4, 44, 7)]


def test_with_before_update_and_delete(spark, sql, ski):
    few = f"WITH few AS (SELECT RESORT_ID FROM {ski}.SKI_RESORT WHERE COUNTRY = ?) "
    n = spark.table(f"{ski}.SKI_RUN").count()
    results = write(
        sql,
        Query(few + f"UPDATE {ski}.SKI_RUN SET DIFFICULTY = 'X' WHERE RESORT_ID IN (SELECT RESORT_ID FROM few)", ["France"]),
        Query(few + f"DELETE FROM {ski}.SKI_RUN WHERE RESORT_ID IN (SELECT RESORT_ID FROM few)", ["France"]),
    )
    assert results[0].affected_rows == results[1].affected_rows > 0
    assert spark.table(f"{ski}.SKI_RUN").count() == n - results[1].affected_rows


def test_ddl_affects_no_rows(spark, sql, schema):
    results = write(
        sql,
        f"CREATE TABLE {schema}.A (X INT) USING parquet",
        f"INSERT INTO {schema}.A VALUES (1), (2)",
        f"SELECT * FROM {schema}.A",
        f"DROP TABLE {schema}.A",
    )
    assert [r.affected_rows for r in results] == [0, 2, None, 0]
    assert results[2].rows.count() == 2


# -- modes -----------------------------------------------------------------------------------------


def test_sequential_keeps_what_came_before(spark, sql, ski):
    with pytest.raises(TableOperationError) as caught:
        write(sql, insert(ski), "INSERT INTO nowhere.t VALUES (1)", insert(ski))
    assert caught.value.item == 1
    assert competitions(spark, ski) == 1
    results = write(sql, insert(ski), "SELECT no_such_column", insert(ski), continue_on_fail=True)
    assert [r.affected_rows for r in results] == [1, None, 1] and "no_such_column" in results[1].error
    assert competitions(spark, ski) == 3


def test_runtime_failure_belongs_to_its_item(sql):
    results = sql.execute(["SELECT 1 AS a", "SELECT raise_error('bad') AS a"], continue_on_fail=True)
    assert results[0].rows.count() == 1 and "bad" in results[1].error


def test_results_do_not_see_later_writes(spark, sql, ski):
    results = write(sql, f"SELECT count(*) AS n FROM {ski}.COMPETITIONS", insert(ski))
    assert results[0].rows.first().n == 0


def test_transaction_commits(spark, sql, ski):
    results = write(sql, insert(ski), insert(ski, 2025), mode="transaction")
    assert [r.affected_rows for r in results] == [1, 1]
    assert competitions(spark, ski) == 2


def test_transaction_rolls_everything_back(spark, sql, ski):
    before = sorted(map(tuple, spark.table(f"{ski}.SKI_RUN").collect()))
    statements = [
        insert(ski),
        f"UPDATE {ski}.SKI_RUN SET RUN_LENGTH = 0",
        f"DELETE FROM {ski}.SKI_RUN WHERE DIFFICULTY = 'Red'",
        f"INSERT INTO {ski}.SKI_RUN VALUES (1, 'x', 'y', 2)",
        f"CREATE TABLE {ski}.MADE (A INT) USING parquet",
        f"SELECT count(*) FROM {ski}.SKI_RUN",
        "NOT SQL AT ALL",
    ]
    with pytest.raises(TableOperationError) as caught:
        write(sql, *statements, mode="transaction")
    assert caught.value.item == 6
    assert competitions(spark, ski) == 0
    assert sorted(map(tuple, spark.table(f"{ski}.SKI_RUN").collect())) == before
    assert not spark.catalog.tableExists(f"{ski}.MADE")
    (result,) = write(sql, *statements, mode="transaction", continue_on_fail=True)
    assert result.item == 6 and result.error


def test_transaction_sees_its_own_writes(spark, sql, ski):
    results = write(
        sql,
        f"DELETE FROM {ski}.SKI_RUN WHERE DIFFICULTY = 'Red'",
        f"SELECT count(*) AS n FROM {ski}.SKI_RUN",
        mode="transaction",
    )
    assert results[0].affected_rows == 3 and results[1].rows.first().n == 4


def test_transaction_on_partitions(spark, sql, operations, schema):
    operations.store.create(schema, "P", "A INT, D STRING", partitioned_by=["D"])
    write(sql, f"INSERT INTO {schema}.P VALUES (1, 'x'), (2, 'y')")
    before = sorted(map(tuple, spark.table(f"{schema}.P").collect()))
    with pytest.raises(TableOperationError):
        write(
            sql,
            f"UPDATE {schema}.P SET A = 9 WHERE D = 'x'",
            f"DELETE FROM {schema}.P WHERE D = 'y'",
            f"INSERT INTO {schema}.P VALUES (3, 'z'), (4, 'x')",
            "SELECT nope",
            mode="transaction",
        )
    assert sorted(map(tuple, spark.table(f"{schema}.P").collect())) == before


def test_transaction_refuses_what_cannot_be_undone(spark, sql, ski):
    for statement in (f"DROP TABLE {ski}.COMPETITIONS", f"INSERT OVERWRITE {ski}.SKI_RUN SELECT * FROM {ski}.SKI_RUN"):
        with pytest.raises(TableOperationError):
            write(sql, statement, mode="transaction")
    assert spark.table(f"{ski}.SKI_RUN").count() == 7


def test_single_batch(spark, sql, ski):
    results = write(sql, insert(ski), insert(ski), insert(ski), mode="single")
    assert [r.affected_rows for r in results] == [1, 1, 1] and competitions(spark, ski) == 3
    results = write(sql, f"CREATE TABLE {ski}.B (A INT) USING parquet", f"INSERT INTO {ski}.B VALUES (1)", mode="single")
    assert [r.affected_rows for r in results] == [0, 1]
    assert sql.execute([], mode="single") == []


def test_single_batch_is_one_verdict(spark, sql, ski):
    statements = [insert(ski), "SELEC nonsense", insert(ski)]
    with pytest.raises(TableOperationError) as caught:
        write(sql, *statements, mode="single")
    assert caught.value.item == 0 and competitions(spark, ski) == 0
    results = write(sql, *statements, mode="single", continue_on_fail=True)
    assert [r.item for r in results] == [0, 1, 2] and len({r.error for r in results}) == 1
    assert competitions(spark, ski) == 0
    with pytest.raises(TableOperationError) as caught:
        write(sql, insert(ski), "  ", mode="single")
    assert caught.value.item == 1


def test_single_batch_with_parameters_runs_sequentially(spark, sql, ski):
    with pytest.warns(UserWarning, match="sequentially"):
        results = write(sql, insert(ski), Query("SELECT ? AS a", [5]), mode="single")
    assert results[0].affected_rows == 1 and results[1].rows.first().a == 5


def test_unknown_mode(sql):
    with pytest.raises(TableOperationError, match="Unknown mode"):
        sql.execute("SELECT 1", mode="parallel")


@pytest.mark.parametrize("parts", [(), ("K",)])
def test_insert_text_counts_what_its_write_wrote(spark, operations, schema, parts, monkeypatch):
    store = operations.store
    store.create(schema, "T", "ID BIGINT, K INT", partitioned_by=list(parts))
    monkeypatch.setattr(type(store), "_files", lambda *_: set())
    for statement, rows in (
        (f"INSERT INTO {schema}.T SELECT id, CAST(id % 3 AS INT) FROM range(1000)", 1000),
        (f"INSERT INTO {schema}.T SELECT id, 1 FROM range(10) WHERE id < 0", 0),
        (f"INSERT INTO {schema}.T VALUES (1, 2), (3, NULL)", 2),
        (f"WITH a AS (SELECT id FROM range(7)) INSERT INTO {schema}.T SELECT id, 0 FROM a", 7),
    ):
        (result,) = write(SqlExecutor(operations), statement)
        assert result.affected_rows == rows, statement
    assert spark.table(f"{schema}.T").count() == 1009
