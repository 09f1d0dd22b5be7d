"""Column expressions shared by the staging, dimension and fact plans.

Every function returns a built-in Column expression, so it stays inside
whole-stage code generation. Functions that depend on the type of their input
take that type as an argument: a value that is already typed is passed through
instead of being turned into text and parsed again.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The open end of a version, the floor of an empty target and the
# key of the unknown member.
END_OF_TIME = "9999-12-31 23:59:59.999999"
START_OF_TIME = "1900-01-01 00:00:00"
UNKNOWN_KEY = 0

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


def safe_int(col: Column, source_type: T.DataType) -> Column:
    """``col`` as bigint, NULL where it cannot be read as an integer.

    Fractional numbers round half away from zero; text must be an integer
    (``'12.5'`` and ``'1e3'`` give NULL).
    """
    if isinstance(source_type, T.LongType):
        return col
    if isinstance(source_type, _INTEGRAL):
        return col.cast("bigint")
    if isinstance(source_type, _FRACTIONAL):
        return F.round(col).try_cast("bigint")
    return col.try_cast("bigint")


def safe_timestamp(col: Column, source_type: T.DataType | None = None) -> Column:
    """``col`` as timestamp_ntz in UTC, NULL where it cannot be parsed.

    Text is cut to 26 characters, which drops a seventh fractional digit.
    """
    if isinstance(source_type, T.TimestampNTZType):
        return col
    if isinstance(source_type, (T.TimestampType, T.DateType)):
        return col.cast("timestamp_ntz")
    # Spark also reads a bare year or a time of day; only text with a full date is kept.
    # Extraction, unlike a condition, needs the text once.
    text = F.regexp_extract(F.substring(col.cast("string"), 1, 26), r"^\s*\d{4}-\d{1,2}-\d{1,2}.*$", 0)
    return text.try_cast("timestamp").cast("timestamp_ntz")


def safe_date(col: Column, source_type: T.DataType | None = None) -> Column:
    """The date in the first ten characters of ``col``, NULL on bad text."""
    if isinstance(source_type, T.DateType):
        return col
    if isinstance(source_type, (T.TimestampType, T.TimestampNTZType)):
        return col.cast("date")
    # A cast also takes a bare year or month, but does not raise and catch an
    # exception for each bad value, as parsing with a pattern does.
    return F.regexp_extract(F.substring(col.cast("string"), 1, 10), r"^\d{4}-\d{1,2}-\d{1,2}$", 0).try_cast("date")


def strict_date(col: Column) -> Column:
    """``col`` as a date; malformed text fails the query (ANSI mode)."""
    return col.cast("date")


def typed_null(type_name: str) -> Column:
    return F.lit(None).cast(type_name)


def ts_literal(text: str) -> Column:
    """A timestamp_ntz literal; without the cast a mix with NTZ columns widens to a zoned type."""
    return F.lit(text).cast("timestamp_ntz")


def with_default(col: Column, value) -> Column:
    return F.coalesce(col, value if isinstance(value, Column) else F.lit(value))


def last_modified(line: Column, header: Column) -> Column:
    """The later of two edit times; NULL only if both are."""
    return F.greatest(line, header)


def flag(col: Column) -> Column:
    """A 0/1 or boolean flag as int, NULL kept."""
    return col.cast("int")
