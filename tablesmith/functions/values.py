"""Typed literals and casts.

A value given for a column is coerced to the *column's* type. Spark is never left to pick a common
type, because a text/number comparison would then go through DOUBLE and lose digits.
"""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal, InvalidOperation

from pyspark.sql import Column, functions as F, types as T

from ..errors import TableOperationError

_INTEGER_RANGE = {
    T.ByteType: 7,
    T.ShortType: 15,
    T.IntegerType: 31,
    T.LongType: 63,
}


def quoted(name: str) -> str:
    """A column name as Spark SQL text, always taken literally."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def is_text(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StringType, T.CharType, T.VarcharType))


def is_integer(dtype: T.DataType) -> bool:
    return type(dtype) in _INTEGER_RANGE


def widens(source: T.DataType, target: T.DataType) -> bool:
    """Whether every value of one integer type is a value of the other."""
    both = is_integer(source) and is_integer(target)
    return both and _INTEGER_RANGE[type(source)] <= _INTEGER_RANGE[type(target)]


def is_exact_number(dtype: T.DataType) -> bool:
    return is_integer(dtype) or isinstance(dtype, T.DecimalType)


def is_approximate_number(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.FloatType, T.DoubleType))


def is_instant(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.TimestampType, T.TimestampNTZType))


def storage_type(dtype: T.DataType) -> T.DataType:
    """The type values have inside a plan; CHAR/VARCHAR lengths are checked on write."""
    return T.StringType() if is_text(dtype) else dtype


def _refuse(value, dtype: T.DataType):
    raise TableOperationError(f"{value!r} is not a valid {dtype.simpleString()} value")


def _as_decimal(value, dtype: T.DataType) -> Decimal:
    if isinstance(value, bool):
        value = int(value)
    try:
        number = Decimal(str(value).strip())
    except InvalidOperation:
        _refuse(value, dtype)
    if not number.is_finite():
        _refuse(value, dtype)
    return number


def _as_datetime(value, dtype: T.DataType) -> dt.datetime:
    """Wall-clock time in UTC."""
    if isinstance(value, str):
        try:
            value = dt.datetime.fromisoformat(value.strip())
        except ValueError:
            _refuse(value, dtype)
    if isinstance(value, dt.datetime):
        if value.tzinfo is not None:
            value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return value
    if isinstance(value, dt.date):
        return dt.datetime(value.year, value.month, value.day)
    _refuse(value, dtype)


def _datetime_text(value: dt.datetime) -> str:
    return value.isoformat(sep=" ", timespec="microseconds")


def _as_text(value) -> str:
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, dt.datetime):
        return _as_datetime(value, T.StringType()).isoformat(sep=" ", timespec="milliseconds")
    if isinstance(value, float) and not math.isfinite(value):
        _refuse(value, T.StringType())
    if isinstance(value, (list, tuple, dict, set)):
        raise TableOperationError("A nested value needs an explicit conversion to text")
    return str(value)


def _as_boolean(value, dtype: T.DataType) -> bool:
    if isinstance(value, bool):
        return value
    if isinstance(value, str) and value.strip().lower() in ("true", "false"):
        return value.strip().lower() == "true"
    if isinstance(value, (int, float)) and value in (0, 1):
        return bool(value)
    _refuse(value, dtype)


def _exact_literal(number: Decimal, dtype: T.DataType) -> Column | None:
    """The number in exactly ``dtype``, or None when it does not fit without change."""
    if is_integer(dtype):
        limit = 2 ** _INTEGER_RANGE[type(dtype)]
        if number == number.to_integral_value() and -limit <= number < limit:
            return F.lit(int(number)).cast(dtype)
        return None
    scaled = number.scaleb(dtype.scale)
    if scaled == scaled.to_integral_value() and abs(scaled) < 10**dtype.precision:
        return F.lit(str(number)).cast(dtype)
    return None


def _free_decimal(number: Decimal) -> Column:
    _, digits, exponent = number.as_tuple()
    scale = max(0, -exponent)
    precision = max(len(digits) + max(0, exponent), scale, 1)
    if precision > 38:
        raise TableOperationError(f"{number} has more digits than a decimal can hold")
    return F.lit(format(number, "f")).cast(T.DecimalType(precision, scale))


def comparison_literal(value, dtype: T.DataType) -> Column:
    """A literal to compare with a column of ``dtype``.

    Where the value fits the type, the literal has exactly that type, so the comparison is pushed
    into the scan. A value that does not fit (1.5 for an integer column) stays a wider number: it
    is a comparison that may fail to match, not an error.
    """
    if value is None:
        return F.lit(None).cast(storage_type(dtype))
    if is_text(dtype):
        return F.lit(_as_text(value))
    if is_exact_number(dtype):
        number = _as_decimal(value, dtype)
        exact = _exact_literal(number, dtype)
        return exact if exact is not None else _free_decimal(number)
    if is_approximate_number(dtype):
        return F.lit(float(_as_decimal(value, dtype))).cast(dtype)
    if isinstance(dtype, T.BooleanType):
        return F.lit(_as_boolean(value, dtype))
    if isinstance(dtype, T.DateType):
        moment = _as_datetime(value, dtype)
        if moment.time() == dt.time():
            return F.lit(moment.date())
        return F.lit(_datetime_text(moment)).cast(T.TimestampNTZType())
    if isinstance(dtype, T.TimestampNTZType):
        return F.lit(_datetime_text(_as_datetime(value, dtype))).cast(dtype)
    if isinstance(dtype, T.TimestampType):
        return F.lit(_datetime_text(_as_datetime(value, dtype)) + " UTC").cast(dtype)
    raise TableOperationError(f"Columns of type {dtype.simpleString()} cannot be compared")


def assignment_literal(value, dtype: T.DataType) -> Column:
    """A literal to store in a column of ``dtype``; a value that does not fit is an error."""
    if value is not None and is_integer(dtype):
        exact = _exact_literal(_as_decimal(value, dtype), dtype)
        if exact is None:
            _refuse(value, dtype)
        return exact
    if value is not None and isinstance(dtype, T.DecimalType):
        number = _as_decimal(value, dtype)
        if abs(number.scaleb(dtype.scale)) >= 10**dtype.precision:
            _refuse(value, dtype)
        return F.lit(format(number, "f")).cast(dtype)
    if isinstance(dtype, T.DateType) and value is not None:
        return F.lit(_as_datetime(value, dtype).date())
    return comparison_literal(value, dtype)


def _wide_decimal(dtype: T.DataType) -> T.DecimalType:
    """A decimal with every integer digit of ``dtype`` and all remaining digits as fraction."""
    if isinstance(dtype, T.DecimalType):
        return T.DecimalType(38, 38 - (dtype.precision - dtype.scale))
    return T.DecimalType(38, 19)


def comparison_cast(value: Column, source: T.DataType, dtype: T.DataType) -> Column:
    """A column of item values, made comparable with a column of ``dtype`` (NULL if impossible)."""
    if is_approximate_number(source):
        sound = ~F.isnan(value) & (F.abs(value) < float("inf"))
        finite = F.when(sound, value)
        if is_text(dtype):
            return finite.cast("string")
        if is_integer(dtype):
            # Beyond every integer, but not beyond the decimal that holds them.
            near = F.greatest(F.least(value, F.lit(2e19)), F.lit(-2e19))
            return F.when(sound, near).try_cast("decimal(38,18)")
        return finite.try_cast(_wide_decimal(dtype)) if is_exact_number(dtype) else finite
    if source == dtype or (is_text(source) and is_text(dtype)):
        return value
    if is_text(dtype):
        return value.cast("string")
    if is_text(source):
        text = F.trim(value)
        if is_exact_number(dtype):
            return text.try_cast(_wide_decimal(dtype))
        if isinstance(dtype, T.DateType):
            return text.try_cast(T.TimestampNTZType())
        number = text.try_cast(dtype)
        if is_approximate_number(dtype):
            return F.when(~F.isnan(number) & (F.abs(number) < float("inf")), number)
        return number
    return value


def key_cast(value: Column, dtype: T.DataType) -> Column:
    """A comparable number as the integer type of the column it must equal; what doesn't fit becomes
    NULL, which equals nothing. The column itself then needs no cast, so scans can use it."""
    return F.when(value == F.floor(value), value).try_cast(dtype)


def assignment_cast(value: Column, source: T.DataType, dtype: T.DataType) -> Column:
    """A column of item values cast for storage (NULL where the value does not fit)."""
    target = storage_type(dtype)
    if source == target or (is_text(source) and is_text(dtype)):
        return value
    if is_text(target):
        return value.cast("string")
    if is_text(source):
        value = F.trim(value)
    converted = value.try_cast(target)
    fractional = is_approximate_number(source) or isinstance(source, T.DecimalType)
    if fractional and is_integer(dtype):
        return F.when(converted == value, converted)
    if is_text(source) and is_integer(dtype):
        number = value.try_cast(T.DecimalType(38, 18))
        return F.when(number == F.floor(number), number).try_cast(target)
    return converted
