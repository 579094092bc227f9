"""The data dictionary: schemas, tables, columns and constraints as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..errors import TableOperationError, require_text
from ..functions.values import quoted
from .tables import TableStore, sql_text

SCHEMAS = "name string, comment string"
TABLES = "schema string, name string, comment string, type string"
COLUMNS = (
    "schema string, table string, position int, name string, type string, nullable boolean, "
    "`default` string, comment string"
)
CONSTRAINT_COLUMNS = (
    "type string, name string, columnName string, position int, referencedSchema string, "
    "referencedTable string, referencedColumn string"
)

ERRORS = "item bigint, error string"

# Fixed value: names beginning like this were made up by an engine, not given by a user.
GENERATED_NAME = "SYS_"


def list_schemas(spark: SparkSession) -> DataFrame:
    rows = [(d.name, d.description or None) for d in spark.catalog.listDatabases()]
    return spark.createDataFrame(rows, SCHEMAS).orderBy("name")


def list_tables(spark: SparkSession, schema: str, include_views: bool = False) -> DataFrame:
    """Tables of a schema, and its views if asked for, ordered by name; an unknown one has none."""
    schema = require_text(schema, "Schema")
    known = spark.catalog.databaseExists(quoted(schema))
    found = [
        (schema, t.name, t.description or None, "VIEW" if t.tableType == "VIEW" else "TABLE")
        for t in (spark.catalog.listTables(quoted(schema)) if known else ())
        if not t.isTemporary
    ]
    every = spark.createDataFrame(found, TABLES)
    tables = every.where(F.col("type") == "TABLE")
    if include_views:
        tables = tables.unionByName(every.where(F.col("type") == "VIEW"))
    return tables.orderBy("name")


def schema_names(spark: SparkSession) -> DataFrame:
    return list_schemas(spark).select("name")


def table_names(spark: SparkSession, schema: str | None, include_views: bool = False) -> DataFrame:
    """Names to choose from; none while no schema is chosen."""
    if not schema:
        return spark.createDataFrame([], "name string")
    return list_tables(spark, schema, include_views).select("name")


def _column_rows(store: TableStore, schema: str, table: str) -> list[tuple]:
    if not store.exists(schema, table):
        return []
    info = store.info(schema, table)
    return [
        (
            schema,
            table,
            position,
            field.name,
            info.declared_type(field.name).upper(),
            field.name not in info.not_null,
            info.defaults.get(field.name),
            field.metadata.get("comment"),
        )
        for position, field in enumerate(info.schema.fields)
    ]


def _constraint_rows(store: TableStore, schema: str, table: str) -> list[tuple]:
    if not store.exists(schema, table):
        return []
    rows = []
    for constraint in store.info(schema, table).constraints:
        referenced = constraint.get("referencedColumns") or []
        for position, column in enumerate(constraint["columns"]):
            rows.append(
                (
                    constraint["type"],
                    constraint["name"],
                    column,
                    position,
                    constraint.get("referencedSchema"),
                    constraint.get("referencedTable"),
                    referenced[position] if position < len(referenced) else None,
                )
            )
    return rows


def describe_columns(store: TableStore, schema: str, table: str) -> DataFrame:
    """One row per column in order; an unknown table has none."""
    schema, table = require_text(schema, "Schema"), require_text(table, "Table")
    rows = _column_rows(store, schema, table)
    return store.spark.createDataFrame(rows, COLUMNS).orderBy("position")


def constraint_columns(store: TableStore, schema: str, table: str) -> DataFrame:
    """One row per (constraint, column), as declared."""
    schema, table = require_text(schema, "Schema"), require_text(table, "Table")
    return store.spark.createDataFrame(_constraint_rows(store, schema, table), CONSTRAINT_COLUMNS)


def grouped_constraints(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per constraint, its columns in key order and paired with the referenced columns.

    A group is as long as a key has columns. Generated names are reported as NULL.
    """
    ordered = F.sort_array(F.collect_list(F.struct("position", "columnName", "referencedColumn")))
    grouped = rows.groupBy(*by, F.col("name").alias("__name")).agg(
        F.min_by("type", "position").alias("type"),
        F.min_by("referencedSchema", "position").alias("referencedSchema"),
        F.min_by("referencedTable", "position").alias("referencedTable"),
        ordered.alias("__parts"),
    )
    referenced = F.filter("__parts", lambda part: part.getField("referencedColumn").isNotNull())
    return grouped.orderBy(*by, "__name").select(
        *by,
        "type",
        F.when(~F.startswith("__name", F.lit(GENERATED_NAME)), F.col("__name")).alias("name"),
        F.col("__parts.columnName").alias("columns"),
        "referencedSchema",
        "referencedTable",
        referenced.getField("referencedColumn").alias("referencedColumns"),
    )


def describe_table(store: TableStore, schema: str, table: str) -> tuple[DataFrame, DataFrame]:
    """(columns, constraints) of a table or view; both empty for an unknown one."""
    columns = describe_columns(store, schema, table).select(
        "name", "type", "nullable", "default", "comment"
    )
    return columns, grouped_constraints(constraint_columns(store, schema, table))


def data_dictionary(store: TableStore, schema: str) -> tuple[DataFrame, DataFrame]:
    """(one row per column, one row per constraint) of every table and view of a schema."""
    spark = store.spark
    names = [row.name for row in list_tables(spark, schema, include_views=True).collect()]
    columns = [row for name in names for row in _column_rows(store, schema, name)]
    constraints = [
        (name, *row) for name in names for row in _constraint_rows(store, schema, name)
    ]
    return (
        spark.createDataFrame(columns, COLUMNS).orderBy("table", "position"),
        grouped_constraints(
            spark.createDataFrame(constraints, "table string, " + CONSTRAINT_COLUMNS), ["table"]
        ),
    )


def list_tables_of(
    spark: SparkSession,
    schemas: Sequence[str],
    include_views: bool = False,
    *,
    continue_on_fail: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """The tables of several schemas, one request each: (rows with ``item``, error rows)."""
    lists, errors = _per_request(
        schemas, lambda schema: list_tables(spark, schema, include_views).collect(), continue_on_fail
    )
    rows = [(item, *row) for item, found in lists for row in found]
    return (
        spark.createDataFrame(rows, "item bigint, " + TABLES).orderBy("item", "name"),
        spark.createDataFrame(errors, ERRORS),
    )


def describe_tables(
    store: TableStore, requests: Sequence[tuple[str, str]], *, continue_on_fail: bool = False
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Several (schema, table) requests: (columns with ``item``, constraints with ``item``, error
    rows)."""

    def describe(request):
        schema, table = require_text(request[0], "Schema"), require_text(request[1], "Table")
        return _column_rows(store, schema, table), _constraint_rows(store, schema, table)

    found, errors = _per_request(requests, describe, continue_on_fail)
    columns = [(item, *row) for item, (rows, _) in found for row in rows]
    constraints = [(item, *row) for item, (_, rows) in found for row in rows]
    spark = store.spark
    return (
        spark.createDataFrame(columns, "item bigint, " + COLUMNS).orderBy("item", "position"),
        grouped_constraints(
            spark.createDataFrame(constraints, "item bigint, " + CONSTRAINT_COLUMNS), ["item"]
        ),
        spark.createDataFrame(errors, ERRORS),
    )


def _per_request(requests, run, continue_on_fail: bool):
    done, errors = [], []
    for item, request in enumerate(requests):
        try:
            done.append((item, run(request)))
        except Exception as error:
            if not continue_on_fail:
                raise TableOperationError(str(error), item) from error
            errors.append((item, str(error)))
    return done, errors


def comment_on_schema(spark: SparkSession, schema: str, comment: str) -> None:
    spark.sql(f"COMMENT ON SCHEMA {quoted(schema)} IS {sql_text(comment)}")


def comment_on_table(spark: SparkSession, schema: str, table: str, comment: str) -> None:
    spark.sql(f"COMMENT ON TABLE {quoted(schema)}.{quoted(table)} IS {sql_text(comment)}")


def comment_on_column(spark: SparkSession, schema: str, table: str, column: str, comment: str):
    spark.sql(
        f"ALTER TABLE {quoted(schema)}.{quoted(table)} "
        f"ALTER COLUMN {quoted(column)} COMMENT {sql_text(comment)}"
    )


def create_view(spark: SparkSession, schema: str, view: str, query: str, comment: str | None = None):
    """A view over SELECT text, with an optional comment."""
    text = f" COMMENT {sql_text(comment)}" if comment is not None else ""
    spark.sql(f"CREATE VIEW {quoted(schema)}.{quoted(view)}{text} AS {query}")


def write_schema(spark: SparkSession) -> str:
    """The schema writes go to: the current one, else the one named after the user."""
    return spark.sql("SELECT coalesce(current_schema(), current_user()) AS name").first().name
