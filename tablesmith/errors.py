"""Exceptions raised by the table operations."""

from __future__ import annotations


class TableOperationError(ValueError):
    """A request that was refused, or a statement that failed.

    ``item`` is the 0-based index of the request that caused it, when one did.
    ``rows`` may hold a lazy DataFrame with every offending row.
    """

    def __init__(self, message: str, item: int | None = None, rows=None):
        super().__init__(message)
        self.item = item
        self.rows = rows


def require_text(value, label: str, item: int | None = None) -> str:
    """Trim a required text field; blank or non-text values are refused."""
    text = value.strip() if isinstance(value, str) else ""
    if not text:
        raise TableOperationError(f"{label} must not be empty", item)
    return text


def require_column_name(value, label: str, item: int | None = None) -> str:
    """Refuse a blank or non-text column name. Column names are not trimmed."""
    if not isinstance(value, str) or not value.strip():
        raise TableOperationError(f"{label} must be a non-empty string.", item)
    return value
