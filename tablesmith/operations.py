"""The table operations on named tables: validate, plan, publish, report.

Requests are either a Python list (each with its own table and literal values, read in order) or one
template together with a set of items. Lists are small by nature; sets of items are DataFrames of any
size and always become one plan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from .errors import TableOperationError
from .functions.ordering import DEFAULT_LIMIT, SortRule
from .functions.predicates import Condition, describe
from .operators.change import OUTCOME_SCHEMA, Change, outcome_rows
from .operators.delete import DeleteStatement, delete_per_item, delete_rows
from .operators.insert import batch_rows, mapping_rows
from .operators.select import concatenated, limited, result_cap, select_per_item, select_rows, tagged
from .operators.update import UpdateStatement, update_per_item, update_rows
from .operators.upsert import Upsert, check_key_columns, check_source, upsert_rows
from .sources.items import ITEM, Items
from .sources.scratch import pinned
from .sources.tables import TableInfo, TableStore

# Literal statements folded into one pass over a table; more would no longer be compiled as one
# function.
STATEMENTS_PER_PASS = 32
BATCH_SCHEMA = "items struct<first: bigint, last: bigint>, affectedRows bigint, error string"


@dataclass(frozen=True)
class SelectRequest:
    schema: str
    table: str
    where: Sequence[Condition] = ()
    combine: str = "AND"
    sort: Sequence[SortRule] = ()
    return_all: bool = True
    limit: object = DEFAULT_LIMIT


@dataclass(frozen=True)
class UpdateRequest:
    schema: str
    table: str
    sets: Mapping[str, object]
    where: Sequence[Condition]
    combine: str = "AND"

    verb = "update"

    def statement(self) -> UpdateStatement:
        return UpdateStatement(self.sets, self.where, self.combine)

    def apply(self, df: DataFrame, statements: Mapping) -> Change:
        return update_rows(df, statements)


@dataclass(frozen=True)
class DeleteRequest:
    schema: str
    table: str
    where: Sequence[Condition]
    combine: str = "AND"
    sets: Mapping[str, object] = field(default_factory=dict, init=False)

    verb = "delete"

    def statement(self) -> DeleteStatement:
        return DeleteStatement(self.where, self.combine)

    def apply(self, df: DataFrame, statements: Mapping) -> Change:
        return delete_rows(df, statements)


def _named(error: Exception, verb: str, target: str, item: int | None) -> TableOperationError:
    """The failure with the statement it belongs to."""
    text = str(error).split("\n\nJVM stacktrace")[0].strip()
    rows = getattr(error, "rows", None)
    return TableOperationError(f"{text} ({verb}: {target})", item, rows)


class TableOperations:
    """Select, insert, update, delete and upsert on the tables of a store."""

    def __init__(self, spark: SparkSession, root: str, *, result_cap: int = 0):
        self.spark = spark
        self.store = TableStore(spark, root)
        self.cap = result_cap

    # -- reading ---------------------------------------------------------------------------------

    def select(
        self, requests: Sequence[SelectRequest] | SelectRequest, *, continue_on_fail: bool = False
    ) -> tuple[DataFrame | None, DataFrame]:
        """(rows of every request in order, tagged with ``item``; error rows).

        Problems found while planning belong to one request. A read that fails while it runs raises
        when the rows are used; it is never turned into an empty result.
        """
        if isinstance(requests, SelectRequest):
            requests = [requests]
        results, errors = [], []
        for item, request in enumerate(requests):
            try:
                info = self.store.info(request.schema, request.table, item)
                limit = limited(request.return_all, request.limit)
                rows = select_rows(
                    self.store.read(info), request.where, request.combine, request.sort, limit
                )
                results.append(tagged(result_cap(rows, self.cap), item))
            except Exception as error:
                target = f"{request.schema}.{request.table} where " + _where_text(request)
                failure = _named(error, "select", target, item)
                if not continue_on_fail:
                    raise failure from error
                errors.append((item, None, str(failure)))
        rows = concatenated(results) if results else None
        return rows, outcome_rows(self.spark, errors).select("item", "error")

    def select_items(
        self,
        schema: str,
        table: str,
        items: Items,
        where: Sequence[Condition],
        combine: str = "AND",
        sort: Sequence[SortRule] = (),
        limit=None,
        *,
        ordered: bool = False,
    ) -> tuple[DataFrame, DataFrame]:
        """One read per item of a set, as one plan: (rows with ``item``, error rows)."""
        info = self.store.info(schema, table)
        target = self.store.read(info)
        return select_per_item(target, items, where, combine, sort, limit, ordered=ordered)

    # -- batch writes ----------------------------------------------------------------------------

    def insert(
        self,
        schema: str,
        table: str,
        items: Items,
        mapping: Mapping[str, object] | str | None = None,
        *,
        continue_on_fail: bool = False,
    ) -> DataFrame:
        """Append all items in one job, all or nothing; one outcome row for the batch.

        ``mapping`` gives the columns and their values for all items; as text, it names a column
        with each item's own mapping; without it, columns come from the first item's keys.
        """

        def run(info: TableInfo, span):
            return self.store.append(info, _rows(items, info, mapping, "insert"))

        return self._batch("insert", schema, table, items, run, continue_on_fail)

    def upsert(
        self,
        schema: str,
        table: str,
        items: Items,
        keys: Sequence[str],
        mapping: Mapping[str, object] | str | None = None,
        *,
        continue_on_fail: bool = False,
    ) -> DataFrame:
        """Update rows whose key is known and insert the rest, all or nothing."""

        def run(info: TableInfo, span):
            source = _rows(items, info, mapping, "upsert")
            check_key_columns([name for name in source.columns if name != ITEM], keys)
            # Two checks, the join and the counts read the source: it is computed once.
            return self.merge(info, pinned(source), keys)

        return self._batch("upsert", schema, table, items, run, continue_on_fail)

    def merge(self, info: TableInfo, source: DataFrame, keys: Sequence[str]) -> int:
        """Publish an upsert of ``source`` (``__item`` and typed columns)."""
        check_source(source, keys)
        full = upsert_rows(self.store.read(info), source, keys)
        if not full.columns:
            # Nothing to update: the unknown keys, found against the whole table, are appended.
            new = pinned(full.inserted)
            return 0 if new.isEmpty() else self.store.append(info, new)
        counts = full.counts.first()
        if counts.affectedRows:

            def change(target: DataFrame) -> Change:
                plan: Upsert = upsert_rows(target, source, keys)
                moved = set(plan.columns) & set(info.partitions)
                return Change(
                    plan.image,
                    plan.counts,
                    plan.touched,
                    plan.columns if moved else (),
                    plan.inserted,
                )

            self.store.publish(info, change)
        return counts.affectedRows

    def _batch(self, verb, schema, table, items: Items, run, continue_on_fail: bool) -> DataFrame:
        span = items.opened().agg(F.min(ITEM).alias("first"), F.max(ITEM).alias("last")).first()
        if span.first is None:
            return self.spark.createDataFrame([], BATCH_SCHEMA)
        indexes = (span.first, span.last)
        try:
            info = self.store.writable(schema, table, 0)
            row = (indexes, run(info, indexes), None)
        except Exception as error:
            item = getattr(error, "item", None)
            failure = _named(error, verb, f"{schema}.{table}", 0 if item is None else item)
            if not continue_on_fail:
                raise failure from error
            row = (indexes, None, str(failure))
        return self.spark.createDataFrame([row], BATCH_SCHEMA)

    # -- literal statements ----------------------------------------------------------------------

    def update(self, requests, *, continue_on_fail: bool = False) -> DataFrame:
        """Literal updates in order; one outcome row per request."""
        return self._statements(requests, continue_on_fail)

    def delete(self, requests, *, continue_on_fail: bool = False) -> DataFrame:
        """Literal deletes in order; one outcome row per request."""
        return self._statements(requests, continue_on_fail)

    def _statements(self, requests, continue_on_fail: bool) -> DataFrame:
        """Neighbouring requests on one table share a pass. Without ``continue_on_fail`` the requests
        before a failing one stay applied, the ones after it are not run."""
        if isinstance(requests, (UpdateRequest, DeleteRequest)):
            requests = [requests]
        outcomes, waiting, table = {}, {}, None

        def flush():
            if waiting:
                self._run_pass(table, dict(waiting), outcomes, continue_on_fail)
                waiting.clear()

        for item, request in enumerate(requests):
            try:
                info = self.store.writable(request.schema, request.table, item)
                # Plans the statement alone, so that a malformed one is found before any work.
                request.apply(self.store.read(info), {item: request.statement()})
            except Exception as error:
                target = f"{request.schema}.{request.table} where " + _where_text(request)
                problem = _named(error, request.verb, target, item)
                if not continue_on_fail:
                    flush()
                    raise problem from error
                outcomes[item] = (None, str(problem))
                continue
            if table is not None and (info.name != table.name or len(waiting) == STATEMENTS_PER_PASS):
                flush()
            table = info
            waiting[item] = request
        flush()
        rows = [(item, *outcomes[item]) for item in sorted(outcomes)]
        return outcome_rows(self.spark, rows)

    def _run_pass(self, info: TableInfo, members: dict, outcomes: dict, continue_on_fail: bool):
        first = next(iter(members.values()))
        statements = {item: request.statement() for item, request in members.items()}

        def change(target: DataFrame) -> Change:
            return first.apply(target, statements)

        try:
            counts = {
                row.item: row.affectedRows
                for row in change(self.store.read(info)).outcome.collect()
            }
            if any(counts.values()):
                self.store.publish(info, change)
        except Exception as error:
            if len(members) > 1:
                # Nothing was published. One by one, to find the statement that failed.
                for item, request in members.items():
                    self._run_pass(info, {item: request}, outcomes, continue_on_fail)
                return
            ((item, request),) = members.items()
            failure = _named(error, request.verb, f"{info.name} where {_where_text(request)}", item)
            if not continue_on_fail:
                raise failure from error
            outcomes[item] = (None, str(failure))
            return
        for item, count in counts.items():
            outcomes[item] = (count, None)

    # -- sets of items ---------------------------------------------------------------------------

    def update_items(
        self,
        schema: str,
        table: str,
        items: Items,
        where: Sequence[Condition],
        combine: str = "AND",
        sets: Mapping[str, object] | None = None,
        *,
        continue_on_fail: bool = False,
    ) -> DataFrame:
        """One update per item of a set, as one plan; one outcome row per item."""

        def change(target: DataFrame, batch: Items) -> Change:
            return update_per_item(target, batch, where, combine, sets)

        return self._items("update", schema, table, items, change, continue_on_fail)

    def delete_items(
        self,
        schema: str,
        table: str,
        items: Items,
        where: Sequence[Condition],
        combine: str = "AND",
        *,
        continue_on_fail: bool = False,
    ) -> DataFrame:
        """One delete per item of a set, as one plan; one outcome row per item."""

        def change(target: DataFrame, batch: Items) -> Change:
            return delete_per_item(target, batch, where, combine)

        return self._items("delete", schema, table, items, change, continue_on_fail)

    def _items(self, verb, schema, table, items: Items, change, continue_on_fail: bool) -> DataFrame:
        if items.df.isEmpty():
            return self.spark.createDataFrame([], OUTCOME_SCHEMA)
        failure = None
        try:
            info = self.store.writable(schema, table, 0)
            batch = Items(pinned(items.df), items.index, items.json)
            # Kept as it is: publishing changes the table the counts were taken from.
            outcome = pinned(change(self.store.read(info), batch).outcome)
            failed = outcome.where(F.col("error").isNotNull())
            first = failed.agg(F.min(F.struct("item", "error")).alias("first")).first().first
            if first is not None and not continue_on_fail:
                failure = TableOperationError(
                    f"{first.error} ({verb}: {info.name})", first.item, failed
                )
                done = batch.df.where(F.col(batch.index) < first.item)
                batch = Items(done, batch.index, batch.json)
                if not done.isEmpty():
                    self._publish_items(info, batch, change)
            elif not outcome.where(F.col("affectedRows") > 0).isEmpty():
                self._publish_items(info, batch, change)
        except Exception as error:
            item = getattr(error, "item", None)
            raise _named(error, verb, f"{schema}.{table}", item) from error
        if failure is not None:
            raise failure
        return outcome

    def _publish_items(self, info: TableInfo, batch: Items, change) -> None:
        self.store.publish(info, lambda target: change(target, batch))


def _rows(items: Items, info: TableInfo, mapping, purpose: str) -> DataFrame:
    if isinstance(mapping, str):
        return mapping_rows(items.df, mapping, info.schema, items.index)
    return batch_rows(items, info.schema, mapping, purpose=purpose)


def _where_text(request) -> str:
    try:
        return describe(request.where, request.combine) or "everything"
    except (AttributeError, TypeError):
        return repr(request.where)
