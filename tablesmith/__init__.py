"""Table operations on Spark: structured reads, batch writes, per-item updates and deletes, keyed
upserts, guarded SQL and a data dictionary, all as DataFrame plans."""

from .errors import TableOperationError
from .functions.ordering import SortRule
from .functions.predicates import Condition, FromItem
from .operations import DeleteRequest, SelectRequest, TableOperations, UpdateRequest
from .operators.query import Query, QueryResult, SqlExecutor
from .session import configure
from .sources.items import Items, index_items, items_from_objects

__all__ = [
    "Condition",
    "DeleteRequest",
    "FromItem",
    "Items",
    "Query",
    "QueryResult",
    "SelectRequest",
    "SortRule",
    "SqlExecutor",
    "TableOperationError",
    "TableOperations",
    "UpdateRequest",
    "configure",
    "index_items",
    "items_from_objects",
]
