"""SQL text: positional parameters, the read-only guard, three ways to commit several statements."""

from __future__ import annotations

import functools
import operator
import re
import uuid
import warnings
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..errors import TableOperationError
from ..functions.guard import require_read_only
from ..functions.parsed import ParsedWrite, as_dataframe, kind, parse, parsed_write, table_name
from ..functions.values import col, quoted
from ..sources.items import ITEM, index_items
from ..sources.scratch import pinned
from .change import Change
from .select import result_cap, tagged, unique_names

# The execution modes.
MODES = ("sequentially", "transaction", "single")

_REPLACE = re.compile(r"^(\s*CREATE\s+)OR\s+REPLACE\s+(TABLE\b)", re.IGNORECASE)
_NOT_UNDOABLE = ("DropTable", "AlterTable", "AlterColumns", "RenameTable", "Truncate", "ReplaceTable")


@dataclass(frozen=True)
class Query:
    sql: str
    params: Sequence = field(default_factory=tuple)


@dataclass(frozen=True)
class QueryResult:
    """What one statement gave: rows, or a number of affected rows, or an error.

    ``more`` says that a result cap left rows out; without a cap nothing is ever left out.
    """

    item: int
    rows: DataFrame | None = None
    affected_rows: int | None = None
    error: str | None = None
    more: bool = False


class SqlExecutor:
    """Runs SQL text against the tables of a ``TableOperations``."""

    def __init__(self, operations, *, cap: int = 0):
        self.operations = operations
        self.store = operations.store
        self.spark = operations.spark
        self.cap = cap

    def execute(
        self,
        queries: Sequence[Query | str] | Query | str,
        *,
        mode: str = "sequentially",
        read_only: bool = True,
        continue_on_fail: bool = False,
    ) -> list[QueryResult]:
        """One result per statement, in order.

        ``sequentially``: each statement stands for itself. ``transaction``: all or none, a failure
        names its statement. ``single``: all statements are checked first, then run all or none
        under one verdict; statements with parameters make it fall back to ``sequentially``.
        """
        if mode not in MODES:
            raise TableOperationError(f"Unknown mode: {mode!r}")
        if isinstance(queries, (str, Query)):
            queries = [queries]
        queries = [Query(q) if isinstance(q, str) else q for q in queries]
        # A result read later must not see what a later statement writes.
        keep = len(queries) > 1 or continue_on_fail
        if mode == "transaction":
            return self._transaction(queries, read_only, continue_on_fail, keep)
        if mode == "single":
            return self._single(queries, read_only, continue_on_fail, keep)
        return self._sequence(queries, read_only, continue_on_fail, keep)

    # -- modes -----------------------------------------------------------------------------------

    def _sequence(self, queries, read_only, continue_on_fail, keep) -> list[QueryResult]:
        results = []
        for item, query in enumerate(queries):
            try:
                self._check(query, read_only, item)
                results.append(self._run(query, item, keep))
            except Exception as error:
                failure = _failure(error, item)
                if not continue_on_fail:
                    raise failure from error
                results.append(QueryResult(item, error=str(failure)))
        return results

    def _transaction(self, queries, read_only, continue_on_fail, keep) -> list[QueryResult]:
        results, item = [], 0
        self.store.begin()
        try:
            for item, query in enumerate(queries):
                self._check(query, read_only, item)
                results.append(self._run(query, item, keep))
            self.store.commit()
            return results
        except Exception as error:
            self.store.rollback()
            failure = _failure(error, item)
            if not continue_on_fail:
                raise failure from error
            return [QueryResult(item, error=str(failure))]

    def _single(self, queries, read_only, continue_on_fail, keep) -> list[QueryResult]:
        if not queries:
            return []
        try:
            for item, query in enumerate(queries):
                self._check(query, read_only, item)
            if any(query.params for query in queries):
                warnings.warn(
                    "The single mode takes statements without parameters only; running them "
                    "sequentially because at least one has parameters.",
                    stacklevel=3,
                )
                return self._sequence(queries, False, continue_on_fail, keep)
            for query in queries:
                parse(self.spark, query.sql)
            self.store.begin()
            try:
                results = [self._run(query, item, keep) for item, query in enumerate(queries)]
                self.store.commit()
            except Exception:
                self.store.rollback()
                raise
            if len(queries) > 1 and len(results) != len(queries):
                raise TableOperationError(
                    f"Expected one result per statement, got {len(results)} for {len(queries)}"
                )
            return results
        except Exception as error:
            item = error.item if isinstance(error, TableOperationError) else None
            failure = _failure(error, 0 if item is None else item)
            if not continue_on_fail:
                raise failure from error
            return [QueryResult(item, error=str(failure)) for item in range(len(queries))]

    # -- one statement ---------------------------------------------------------------------------

    def _check(self, query: Query, read_only: bool, item: int) -> None:
        if not isinstance(query.sql, str) or not query.sql.strip():
            raise TableOperationError("SQL query must not be empty", item)
        if read_only:
            require_read_only(self.spark, query.sql, item)

    def _run(self, query: Query, item: int, keep: bool) -> QueryResult:
        node = parse(self.spark, query.sql)
        write = parsed_write(self.spark, query.sql, node)
        if write is not None:
            return QueryResult(item, affected_rows=self._write(query, write))
        in_transaction = self.store.undo is not None
        if in_transaction and kind(node).startswith(_NOT_UNDOABLE):
            raise TableOperationError("This statement cannot be part of a transaction", item)
        if kind(node).startswith("ReplaceTable"):
            return QueryResult(item, affected_rows=self._replace(query, node))
        if in_transaction and kind(node).startswith("CreateTable"):
            return QueryResult(item, affected_rows=self._create(query, node))
        if in_transaction and kind(node).startswith("Create"):
            raise TableOperationError("Only tables can be created inside a transaction", item)
        result = self.spark.sql(query.sql, args=list(query.params) or None)
        if not result.columns:
            return QueryResult(item, affected_rows=0)
        named = unique_names(result)
        more = self.cap > 0 and not named.offset(self.cap).isEmpty()
        rows = tagged(result_cap(named, self.cap), item)
        return QueryResult(item, rows=pinned(rows) if keep else rows, more=more)

    def _create(self, query: Query, node) -> int:
        """CREATE TABLE inside a transaction: done at once, dropped again on rollback."""
        names = node.name().nameParts()
        name = table_name([names.apply(i) for i in range(names.size())])
        existed = self.spark.catalog.tableExists(name)
        self.spark.sql(query.sql, args=list(query.params) or None)
        if not existed:
            self.store.undo.append(lambda: self.spark.sql(f"DROP TABLE IF EXISTS {name}"))
        return 0

    def _replace(self, query: Query, node) -> int:
        """CREATE OR REPLACE TABLE: the session catalog knows only dropping and creating."""
        plain, n = _REPLACE.subn(r"\1\2", query.sql, count=1)
        if not n:
            raise TableOperationError("Write CREATE OR REPLACE TABLE at the start of the statement")
        names = node.name().nameParts()
        self.spark.sql(f"DROP TABLE IF EXISTS {table_name([names.apply(i) for i in range(names.size())])}")
        self.spark.sql(plain, args=list(query.params) or None)
        return 0

    def _write(self, query: Query, write: ParsedWrite) -> int:
        parts = write.table if len(write.table) > 1 else [self.spark.catalog.currentDatabase(), *write.table]
        info = self.store.writable(parts[-2], parts[-1])
        if write.verb == "insert":
            if write.overwrite and self.store.undo is not None:
                raise TableOperationError("INSERT OVERWRITE cannot be part of a transaction")
            return self.store.insert_statement(info, query.sql, query.params)
        if write.verb == "merge":
            return self._merge(info, write, query)

        def change(target: DataFrame) -> Change:
            return marked_change(self.spark, target, write, query.params)

        affected = change(self.store.read(info)).outcome.first().affectedRows
        if affected:
            self.store.publish(info, change)
        return affected

    def _merge(self, info, write: ParsedWrite, query: Query) -> int:
        """MERGE: an upsert if it has the shape of one, else branch by branch."""
        if write.branches:
            target = self.store.read(info)
            check_merge(self.spark, target, write, query.params)
            affected = merge_change(self.spark, target, write, query.params).outcome.first().affectedRows
            if affected:
                self.store.publish(info, lambda rows: merge_change(self.spark, rows, write, query.params))
            return affected
        inserts, keys = dict(write.inserts), dict(write.keys)
        left_out = set(inserts) - set(keys) - {name for name, _ in write.assignments}
        unknown = [name for name in inserts if name not in info.schema.names]
        if unknown:
            raise TableOperationError(f"Unknown column(s): {', '.join(unknown)}")
        if not write.assignments and left_out:
            return self._merge_inserts(info, write, list(keys))
        source = self._merge_source(info, write)
        return self.operations.merge(info, source, list(keys))

    def _merge_source(self, info, write: ParsedWrite) -> DataFrame:
        rows = as_dataframe(self.spark, write.source).select(
            *[
                F.expr(text).cast(info.schema[name].dataType).alias(name)
                for name, text in write.inserts
            ]
        )
        return pinned(index_items(rows, [name for name, _ in write.keys], ITEM))

    def _merge_inserts(self, info, write: ParsedWrite, keys: list[str]) -> int:
        """MERGE that only inserts: matched rows stay, the rest is appended."""
        from .upsert import check_source, upsert_rows

        source = self._merge_source(info, write)
        check_source(source, keys)
        new = upsert_rows(self.store.read(info), source, keys).inserted
        columns = [col(name) for name, _ in write.inserts]
        new = pinned(new.select(*columns))
        return 0 if new.isEmpty() else self.store.append(info, new)


def marked_change(spark, target: DataFrame, write: ParsedWrite, params: Sequence = ()) -> Change:
    """An UPDATE or DELETE as a query over the table: its expressions, in their own order, next
    to every column, so that positional parameters keep their places."""
    names = target.columns
    unknown = [name for name, _ in write.assignments if name not in names]
    if unknown:
        raise TableOperationError(f"Unknown column(s): {', '.join(unknown)}")
    view = f"tablesmith_{uuid.uuid4().hex}"
    own = quoted(write.alias)
    # Line ends keep a comment at the end of a piece from swallowing what follows.
    extra = [f"({text}\n) AS `__v{i}`" for i, (_, text) in enumerate(write.assignments)]
    extra.append(f"coalesce(({write.condition or 'true'}\n), false) AS `__hit`")
    target.createOrReplaceTempView(view)
    try:
        marked = spark.sql(
            f"{write.before} SELECT {own}.*, {', '.join(extra)} FROM {view} AS {own}",
            args=list(params) or None,
        )
    finally:
        spark.catalog.dropTempView(view)
    hit = F.col("__hit")
    new = {name: i for i, (name, _) in enumerate(write.assignments)}
    kept = marked if write.verb == "update" else marked.where(~hit)
    image = kept.select(
        *[
            F.when(hit, F.col(f"__v{new[name]}").cast(target.schema[name].dataType))
            .otherwise(col(name))
            .alias(name)
            if name in new
            else col(name)
            for name in names
        ]
    )
    outcome = marked.agg(F.count_if(hit).alias("affectedRows"))
    touched = marked.where(hit).select(*[col(name) for name in names])
    return Change(image, outcome, touched, tuple(new))


_ROW, _HERE = "__row", "__here"


def _merged(spark, target: DataFrame, write: ParsedWrite, params: Sequence) -> DataFrame:
    """Table and source joined once: the table's columns, ``__row`` (NULL for new rows), ``__here`` (NULL
    without a source row), per branch whether it is taken (``__c<k>``) and its values (``__v<k>_<i>``).

    The pieces of the statement keep their order, so positional parameters keep their places, and a
    branch's values are only computed where it is taken.
    """
    view, own, other = f"tablesmith_{uuid.uuid4().hex}", quoted(write.alias), quoted(write.source_alias)
    kinds = {
        "matched": f"{own}.{_ROW} IS NOT NULL AND {other}.{_HERE} IS NOT NULL",
        "new": f"{own}.{_ROW} IS NULL",
        "unmatched": f"{other}.{_HERE} IS NULL",
    }
    join = "FULL OUTER" if any(branch.rows == "new" for branch in write.branches) else "LEFT"
    steps, results = [], []
    for k, branch in enumerate(write.branches):
        earlier = "".join(f" AND NOT `__c{j}`" for j in range(k) if write.branches[j].rows == branch.rows)
        steps.append(f"{kinds[branch.rows]}{earlier} AND coalesce(({branch.condition or 'true'}\n), false) AS `__c{k}`")
        results.append(f"`__c{k}`")
        for i, (_, text) in enumerate(_values(target, write, branch)):
            steps.append(f"CASE WHEN `__c{k}` THEN ({text}\n) END AS `__v{k}_{i}`")
            results.append(f"`__v{k}_{i}`")
    target.withColumn(_ROW, F.monotonically_increasing_id()).createOrReplaceTempView(view)
    extended = " ".join(f"|> EXTEND {step}" for step in steps)
    try:
        return spark.sql(
            f"{write.before} FROM {view} AS {own} {join} JOIN (SELECT *, true AS {_HERE} FROM {write.source_text}\n) AS {other} "
            f"ON ({write.on}\n) {extended} |> SELECT {own}.*, {other}.{_HERE} AS {_HERE}, {', '.join(results)}",
            args=list(params) or None,
        )
    finally:
        spark.catalog.dropTempView(view)


def _values(target: DataFrame, write: ParsedWrite, branch) -> list[tuple[str, str]]:
    if branch.star:
        return [(name, f"{quoted(write.source_alias)}.{quoted(name)}") for name in target.columns]
    unknown = [name for name, _ in branch.assignments if name not in target.columns]
    if unknown:
        raise TableOperationError(f"Unknown column(s): {', '.join(unknown)}")
    return branch.assignments


def _taken(write: ParsedWrite, verbs: Sequence[str]) -> Column:
    return functools.reduce(
        operator.or_, [F.col(f"__c{k}") for k, b in enumerate(write.branches) if b.verb in verbs], F.lit(False)
    )


def check_merge(spark, target: DataFrame, write: ParsedWrite, params: Sequence = ()) -> None:
    """Refuse a MERGE in which two source rows change one row of the table."""
    changed = _merged(spark, target, write, params).where(_taken(write, ("update", "delete")))
    twice = changed.where(F.col(_HERE)).groupBy(_ROW).count().where("count > 1")
    if not twice.isEmpty():
        raise TableOperationError("MERGE: more than one source row changes the same row of the table")


def merge_change(spark, target: DataFrame, write: ParsedWrite, params: Sequence = ()) -> Change:
    """A MERGE with conditions and any branches, as one join. The first branch that holds is taken."""
    names = target.columns
    merged = _merged(spark, target, write, params)
    # A row that several source rows match is there once, with the one that changes it, if any.
    matched = merged.where(F.col(_ROW).isNotNull())
    acted = _taken(write, ("update", "delete"))
    if not matched.where(F.col(_HERE)).groupBy(_ROW).count().where("count > 1").isEmpty():
        one = Window.partitionBy(_ROW).orderBy(acted.desc())
        matched = matched.withColumn("__nth", F.row_number().over(one)).where("__nth = 1").drop("__nth")

    def image_of(name: str, verb: str, otherwise: Column) -> Column:
        value = otherwise
        for k, branch in reversed(list(enumerate(write.branches))):
            places = [i for i, (column, _) in enumerate(_values(target, write, branch)) if column == name]
            if branch.verb == verb:
                new = F.col(f"__v{k}_{places[-1]}").cast(target.schema[name].dataType) if places else otherwise
                value = F.when(F.col(f"__c{k}"), new).otherwise(value)
        return value.alias(name)

    kept = matched.where(~_taken(write, ("delete",))).select(*[image_of(n, "update", col(n)) for n in names])
    new = merged.where(F.col(_ROW).isNull() & _taken(write, ("insert",)))
    new = new.select(*[image_of(n, "insert", F.lit(None).cast(target.schema[n].dataType)) for n in names])
    rows = merged.where(_taken(write, ("update", "delete", "insert")))
    changed = {n for b in write.branches if b.verb == "update" for n, _ in _values(target, write, b)}
    return Change(
        kept.unionByName(new),
        rows.agg(F.count("*").alias("affectedRows")),
        # Matched rows that no branch takes are read again, too: they keep source rows from being new.
        matched.where(acted | F.col(_HERE)).select(*[col(n) for n in names]),
        tuple(sorted(changed)),
        new,
    )


def merge_statement(spark, target: DataFrame, statement: str, params: Sequence = ()) -> Change:
    """What a MERGE given as text does to the rows of ``target``."""
    write = parsed_write(spark, statement, parse(spark, statement))
    if write is None or write.verb != "merge":
        raise TableOperationError("Not a MERGE")
    if not write.branches:
        raise TableOperationError("This MERGE is an upsert; use upsert_rows")
    check_merge(spark, target, write, params)
    return merge_change(spark, target, write, params)


def statement_change(spark, target: DataFrame, statement: str, params: Sequence = ()) -> Change:
    """What an UPDATE or DELETE given as text does to the rows of ``target``: the table afterwards, the
    rows it hits, and how many they are."""
    write = parsed_write(spark, statement, parse(spark, statement))
    if write is None or write.verb not in ("update", "delete"):
        raise TableOperationError("Only UPDATE and DELETE change the rows of one table")
    return marked_change(spark, target, write, params)


def _failure(error: Exception, item: int) -> TableOperationError:
    if isinstance(error, TableOperationError) and error.item is not None:
        return error
    text = str(error).split("\n\nJVM stacktrace")[0].strip()
    return TableOperationError(text, item, getattr(error, "rows", None))
