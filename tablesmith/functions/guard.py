"""The read-only guard: which SQL statements may run while writes are switched off.

Two layers, and a statement must pass both. The lexical layer is built from Column expressions, so
it can judge a whole column of statements. The second layer asks Spark's own parser what kind of statement it is,
because Spark knows more ways to quote and more statements than the lexical rule.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..errors import TableOperationError
from .parsed import parse, writes_or_runs

# Words that make a statement something other than a plain read.
PROHIBITED_WORDS = (
    "INSERT",
    "UPDATE",
    "DELETE",
    "MERGE",
    "CREATE",
    "DROP",
    "ALTER",
    "TRUNCATE",
    "GRANT",
    "REVOKE",
    "CALL",
    "INTO",
)

# The three verdicts.
READ_ONLY = "read-only"
NOT_A_SELECT = "not a select"
UNTERMINATED = "unterminated"

# One alternation matched from left to right finds every quoted span and comment where it starts, so
# a quote inside another kind of span is not mistaken for an opening one. Possessive quantifiers keep
# a match from backing into a span that is not closed. The look-ahead passes over plain text quickly.
_SPAN = (
    r"(?=['\"`/-])(?:"
    r"'[^'\\]*+(?:(?:\\(?s:.)|'')[^'\\]*+)*+'"
    r'|"[^"\\]*+(?:(?:\\(?s:.)|"")[^"\\]*+)*+"'
    r"|`[^`]*+(?:``[^`]*+)*+`"
    r"|--[^\n]*+"
    r"|/\*[^*]*+(?:\*(?!/)[^*]*+)*+\*/)"
)
_OPENERS = ("'", '"', "`", "/*")


def _has_word(bare: Column, words) -> Column:
    """A word starts at a letter or underscore; digits before it do not belong to it."""
    first = "".join(sorted({word[0] + word[0].lower() for word in words}))
    # Most places are passed over by their first character alone.
    return bare.rlike(rf"(?=[0-9{first}])(?i)(?<!\w)[0-9]*+(?:{'|'.join(words)})(?!\w)")


def lexical_verdicts(df: DataFrame, statement: str, verdict: str = "verdict") -> DataFrame:
    """Judge a column of statements by their words outside quotes and comments.

    The stripped text is a column of its own, so it is made once and looked at three times.
    """
    bare = F.col("__bare")
    opened = functools.reduce(operator.or_, [bare.contains(mark) for mark in _OPENERS])
    reads = _has_word(bare, ["SELECT"]) & ~_has_word(bare, PROHIBITED_WORDS)
    judged = (
        F.when(opened, UNTERMINATED)
        .when(reads, READ_ONLY)
        .otherwise(NOT_A_SELECT)
    )
    stripped = df.withColumn("__bare", F.regexp_replace(statement, F.lit(_SPAN), F.lit(" ")))
    return stripped.withColumn(verdict, judged).drop("__bare")


def require_read_only(spark: SparkSession, statement: str, item: int | None = None) -> None:
    """Refuse a statement that is not a read."""
    row = spark.createDataFrame([(statement,)], "statement string")
    verdict = lexical_verdicts(row, "statement").first().verdict
    if verdict == UNTERMINATED:
        raise TableOperationError(
            "Writes are off, and a quote or comment in this statement never ends, so what it does is unclear.",
            item,
        )
    if verdict == NOT_A_SELECT or writes_or_runs(spark, parse(spark, statement)):
        raise TableOperationError(
            "Writes are off, and this statement is more than a read.",
            item,
        )
