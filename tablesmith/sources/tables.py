"""Tables on shared storage: definitions, versions, publishing.

A table is an external Parquet table of the session catalog. A change writes a complete new set of
files next to the old one and then moves the catalog's pointer: the table's location, or for a
partitioned table the locations of just those partitions the change touches. Files in use are never
overwritten, so a failed write leaves the table as it was. One writer at a time is assumed.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from ..errors import TableOperationError, require_text
from ..functions.values import assignment_literal, col, quoted, storage_type

# Table properties holding what the session catalog does not accept as DDL.
CONSTRAINTS = "tablesmith.constraints"
NOT_NULL = "tablesmith.notNull"

_SIZED_TEXT = re.compile(r"(?:var)?char\((\d+)\)")


def _batches(parts: Sequence[str], size: int = 100) -> list[Sequence[str]]:
    return [parts[start : start + size] for start in range(0, len(parts), size)]


def sql_text(value: str) -> str:
    """A string literal in Spark SQL."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass(frozen=True)
class TableInfo:
    """What the catalog knows about one table or view."""

    schema_name: str
    table_name: str
    kind: str
    comment: str | None
    properties: Mapping[str, str]
    location: str | None
    partitions: tuple[str, ...]
    defaults: Mapping[str, str]
    schema: T.StructType

    @property
    def name(self) -> str:
        return f"{quoted(self.schema_name)}.{quoted(self.table_name)}"

    @property
    def is_view(self) -> bool:
        return self.kind == "VIEW"

    @property
    def not_null(self) -> list[str]:
        return json.loads(self.properties.get(NOT_NULL, "[]"))

    @property
    def constraints(self) -> list[dict]:
        return json.loads(self.properties.get(CONSTRAINTS, "[]"))

    def declared_type(self, column: str) -> str:
        field = self.schema[column]
        return field.metadata.get("__CHAR_VARCHAR_TYPE_STRING") or field.dataType.simpleString()

    def text_limit(self, column: str) -> int | None:
        sized = _SIZED_TEXT.fullmatch(self.declared_type(column))
        return int(sized.group(1)) if sized else None


def _rows_written(done: DataFrame) -> int:
    """The rows of a statement that has run, as its write counted them when it committed its tasks."""
    plan = done._jdf.queryExecution().executedPlan()
    written = plan.commandPhysicalPlan().metrics().get("numOutputRows")
    if written.isEmpty():
        raise TableOperationError("The statement did not say how many rows it wrote.")
    return written.get().value()


class TableStore:
    """Definitions and published versions of tables whose files live under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        # Inside a transaction: what to run, last first, to take the published changes back.
        self.undo: list[Callable[[], None]] | None = None

    # -- definitions -----------------------------------------------------------------------------

    def exists(self, schema: str, table: str) -> bool:
        return self.spark.catalog.tableExists(f"{quoted(schema)}.{quoted(table)}")

    def info(self, schema: str, table: str, item: int | None = None) -> TableInfo:
        schema = require_text(schema, "Schema", item)
        table = require_text(table, "Table", item)
        name = f"{quoted(schema)}.{quoted(table)}"
        if not self.spark.catalog.tableExists(name):
            raise TableOperationError(f"Table or view {name} does not exist", item)
        row = self.spark.sql(f"DESCRIBE TABLE EXTENDED {name} AS JSON").first()
        found = json.loads(row[0])
        return TableInfo(
            schema,
            table,
            found["type"],
            found.get("comment") or None,
            found.get("table_properties", {}),
            found.get("location"),
            tuple(found.get("partition_columns", ())),
            {c["name"]: c["default"] for c in found["columns"] if c.get("default") is not None},
            self.spark.table(name).schema,
        )

    def writable(self, schema: str, table: str, item: int | None = None) -> TableInfo:
        info = self.info(schema, table, item)
        if info.is_view:
            raise TableOperationError(f"{info.name} is a view and cannot be written to", item)
        return info

    def read(self, info: TableInfo) -> DataFrame:
        return self.spark.table(info.name)

    def create(
        self,
        schema: str,
        table: str,
        columns: str,
        *,
        comment: str | None = None,
        partitioned_by: Sequence[str] = (),
        constraints: Sequence[Mapping] = (),
        not_null: Sequence[str] = (),
        if_not_exists: bool = False,
        or_replace: bool = False,
    ) -> None:
        """Create an empty table. ``columns`` is Spark DDL. Constraints are informational, as key
        columns are; NOT NULL is enforced on every write through this store."""
        schema, table = require_text(schema, "Schema"), require_text(table, "Table")
        name = f"{quoted(schema)}.{quoted(table)}"
        if self.exists(schema, table):
            if if_not_exists:
                return
            if not or_replace:
                raise TableOperationError(f"Table {name} already exists")
            if self.undo is not None:
                raise TableOperationError("A table cannot be replaced inside a transaction")
            self.spark.sql(f"DROP TABLE {name}")
        properties = {
            CONSTRAINTS: json.dumps([dict(c) for c in constraints]),
            NOT_NULL: json.dumps(list(not_null)),
        }
        listed = ", ".join(f"{sql_text(k)} = {sql_text(v)}" for k, v in properties.items())
        parts = ", ".join(quoted(column) for column in partitioned_by)
        self.spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet"
            + (f" PARTITIONED BY ({parts})" if parts else "")
            + f" LOCATION {sql_text(self._new_location(schema, table))}"
            + (f" COMMENT {sql_text(comment)}" if comment is not None else "")
            + f" TBLPROPERTIES ({listed})"
        )
        self._on_undo(lambda: self.spark.sql(f"DROP TABLE IF EXISTS {name}"))

    # -- writing ---------------------------------------------------------------------------------

    def append(self, info: TableInfo, rows: DataFrame) -> int:
        """Append rows in one job; columns they lack take their default. Returns their number."""
        columns = [name for name in rows.columns if name in info.schema.names]
        missing = [name for name in info.not_null if name not in columns]
        missing = [name for name in missing if name not in info.defaults]
        if missing:
            raise TableOperationError(f"Column(s) without a value: {', '.join(missing)}")
        observed = Observation()
        checked = self._checked(info, rows.select(*[col(name) for name in columns]))
        counted = checked.observe(observed, F.count(F.lit(1)).alias("rows"))
        counted = self._gathered(info, counted)
        view = f"tablesmith_{uuid.uuid4().hex}"
        listed = ", ".join(quoted(name) for name in columns)
        before = self._files(info)
        counted.createOrReplaceTempView(view)
        try:
            self.spark.sql(f"INSERT INTO {info.name} ({listed}) SELECT {listed} FROM {view}")
        finally:
            self.spark.catalog.dropTempView(view)
        self._on_undo(lambda: self._remove_new_files(info, before))
        return observed.get["rows"]

    def insert_statement(self, info: TableInfo, statement: str, args: Sequence) -> int:
        """Run an INSERT given as SQL text and count the rows it added."""
        before = self._files(info)
        done = self.spark.sql(statement, args=list(args) or None)
        self._on_undo(lambda: self._remove_new_files(info, before))
        self.spark.catalog.refreshTable(info.name)
        return _rows_written(done)

    def publish(self, info: TableInfo, change: Callable[[DataFrame], object]) -> None:
        """Make the outcome of ``change`` the table's content.

        ``change`` maps the table's rows to an object with ``image``, ``touched``, ``columns`` and
        possibly ``added``. For a partitioned table whose partition columns stay as they are, only
        the partitions with touched or added rows are read again and rewritten.
        """
        target = self.read(info)
        if not info.partitions:
            self._publish_whole(info, change(target).image)
            return
        whole = change(target)
        touched = None
        if not set(info.partitions) & set(whole.columns):
            touched = self._partition_values(info, whole)
        if touched is None:
            touched = self._all_partitions(info)
            self._publish_partitions(info, whole.image, touched)
        elif touched:
            pruned = target.where(self._in_partitions(info, touched))
            self._publish_partitions(info, change(pruned).image, touched)

    def _partition_values(self, info: TableInfo, change) -> list:
        """The touched partitions, whose number the catalog already holds."""
        parts = [col(name) for name in info.partitions]
        rows = change.touched.select(*parts)
        added = getattr(change, "added", None)
        if added is not None:
            rows = rows.unionByName(added.select(*parts))
        return [tuple(row) for row in rows.distinct().collect()]

    def _all_partitions(self, info: TableInfo) -> list:
        rows = self.read(info).select(*[col(name) for name in info.partitions]).distinct()
        return [tuple(row) for row in rows.collect()]

    def _in_partitions(self, info: TableInfo, values: Sequence[tuple]) -> Column:
        """A filter on partition columns only, so untouched partitions are never listed or read."""
        if len(info.partitions) == 1:
            name = info.partitions[0]
            known = [value for (value,) in values if value is not None]
            test = col(name).isin(known) if known else F.lit(False)
            return test | col(name).isNull() if len(known) < len(values) else test
        tests = []
        for row in values:
            test = F.lit(True)
            for name, value in zip(info.partitions, row):
                dtype = info.schema[name].dataType
                test = test & col(name).eqNullSafe(assignment_literal(value, dtype))
            tests.append(test)
        # A balanced tree: thousands of partitions must not nest thousands of levels deep.
        while len(tests) > 1:
            pairs = [tests[i : i + 2] for i in range(0, len(tests), 2)]
            tests = [pair[0] | pair[1] if len(pair) == 2 else pair[0] for pair in pairs]
        return tests[0]

    def _publish_whole(self, info: TableInfo, image: DataFrame) -> None:
        location = self._new_location(info.schema_name, info.table_name)
        self._checked(info, image).write.mode("errorifexists").parquet(location)
        self._set_location(info.name, location, info.location)

    def _publish_partitions(self, info: TableInfo, image: DataFrame, touched: list) -> None:
        location = self._new_location(info.schema_name, info.table_name)
        parts = list(info.partitions)
        checked = self._gathered(info, self._checked(info, image))
        checked.write.mode("errorifexists").partitionBy(*parts).parquet(location)
        written = (
            self.spark.read.schema(checked.schema)
            .parquet(location)
            .select(
                *[col(name) for name in parts],
                F.regexp_extract("_metadata.file_path", "^(.*)/[^/]*$", 1).alias("__folder"),
            )
            .distinct()
        )
        folders = {tuple(row)[:-1]: unquote(row["__folder"]) for row in written.collect()}
        gone = [values for values in touched if values not in folders]
        moved = [*folders, *gone]
        before = self._partition_locations(info, moved)

        def back():
            self._move_partitions(info, before, moved)

        try:
            self._move_partitions(info, folders, gone)
        except Exception as error:
            # Some of them may have moved: all or none.
            try:
                back()
            except Exception:
                raise TableOperationError(f"{info.name} is left with partitions of two versions: {error}") from error
            raise
        self._on_undo(back)

    def _move_partitions(self, info: TableInfo, folders: Mapping, gone: Sequence[tuple]) -> None:
        """Point the catalog at new folders; ``gone`` partitions without a folder are dropped."""
        alter = f"ALTER TABLE {info.name}"
        added = [
            f"PARTITION {self._partition_spec(info, values)} LOCATION {sql_text(folder)}"
            for values, folder in folders.items()
        ]
        for batch in _batches(added):
            self.spark.sql(f"{alter} ADD IF NOT EXISTS {' '.join(batch)}")
        for values, folder in folders.items():
            spec = self._partition_spec(info, values)
            self.spark.sql(f"{alter} PARTITION {spec} SET LOCATION {sql_text(folder)}")
        dropped = [
            f"PARTITION {self._partition_spec(info, values)}"
            for values in gone
            if values not in folders
        ]
        for batch in _batches(dropped):
            self.spark.sql(f"{alter} DROP IF EXISTS {', '.join(batch)}")
        self.spark.catalog.refreshTable(info.name)

    def _partition_spec(self, info: TableInfo, values: tuple) -> str:
        pairs = []
        for name, value in zip(info.partitions, values):
            text = "NULL" if value is None else sql_text(str(value))
            pairs.append(f"{quoted(name)} = {text}")
        return f"({', '.join(pairs)})"

    def _partition_locations(self, info: TableInfo, wanted: Sequence[tuple]) -> dict:
        """Where the wanted partitions are now; partitions the catalog does not know are absent."""
        locations = {}
        for values in wanted:
            spec = self._partition_spec(info, values)
            if self.spark.sql(f"SHOW PARTITIONS {info.name} PARTITION {spec}").first() is None:
                continue
            described = f"DESCRIBE TABLE EXTENDED {info.name} PARTITION {spec} AS JSON"
            locations[values] = json.loads(self.spark.sql(described).first()[0])["location"]
        return locations

    def _set_location(self, name: str, new: str, old: str) -> None:
        def move(location):
            self.spark.sql(f"ALTER TABLE {name} SET LOCATION {sql_text(location)}")
            self.spark.catalog.refreshTable(name)

        move(new)
        self._on_undo(lambda: move(old))

    def _new_location(self, schema: str, table: str) -> str:
        return f"{self.root}/{schema}/{table}/v{uuid.uuid4().hex}"

    def _gathered(self, info: TableInfo, rows: DataFrame) -> DataFrame:
        """Rows of one partition brought together, so that not every task writes a file into every
        partition. Spark splits a partition that is too big for one task and joins small ones."""
        parts = [name for name in info.partitions if name in rows.columns]
        return rows.hint("rebalance", *parts) if parts else rows

    def _checked(self, info: TableInfo, rows: DataFrame) -> DataFrame:
        """Values checked against NOT NULL and text lengths in the pass that writes them."""
        columns = []
        for name in rows.columns:
            value = col(name).cast(storage_type(info.schema[name].dataType))
            limit = info.text_limit(name)
            if name in info.not_null:
                problem = F.raise_error(F.lit(f'Column "{name}" must not be NULL'))
                value = F.when(value.isNull(), problem).otherwise(value)
            if limit is not None:
                problem = F.raise_error(F.lit(f'Column "{name}" holds at most {limit} characters'))
                value = F.when(F.char_length(value) > limit, problem).otherwise(value)
            columns.append(value.alias(name))
        return rows.select(*columns)

    # -- transactions ----------------------------------------------------------------------------

    def begin(self) -> None:
        self.undo = []

    def commit(self) -> None:
        self.undo = None

    def rollback(self) -> None:
        steps, self.undo = self.undo or [], None
        for step in reversed(steps):
            step()

    def _on_undo(self, step: Callable[[], object]) -> None:
        if self.undo is not None:
            self.undo.append(step)

    def _files(self, info: TableInfo) -> set[str]:
        """The table's files, listed only where an append may have to be taken back."""
        if self.undo is None:
            return set()
        self.spark.catalog.refreshTable(info.name)
        return set(self.read(info).inputFiles())

    def _remove_new_files(self, info: TableInfo, before: set[str]) -> None:
        self.spark.catalog.refreshTable(info.name)
        added = set(self.read(info).inputFiles()) - before
        path_class = self.spark._jvm.org.apache.hadoop.fs.Path
        configuration = self.spark._jsc.hadoopConfiguration()
        for file in sorted(added):
            path = path_class(unquote(file))
            path.getFileSystem(configuration).delete(path, False)
        self.spark.catalog.refreshTable(info.name)
