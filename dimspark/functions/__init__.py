from dimspark.functions.periods import covers_closed_open, covers_open_closed
from dimspark.functions.scalars import (
    END_OF_TIME,
    START_OF_TIME,
    UNKNOWN_KEY,
    flag,
    last_modified,
    safe_date,
    safe_int,
    safe_timestamp,
    strict_date,
    ts_literal,
    typed_null,
    with_default,
)

__all__ = [
    "END_OF_TIME",
    "START_OF_TIME",
    "UNKNOWN_KEY",
    "covers_closed_open",
    "covers_open_closed",
    "flag",
    "last_modified",
    "safe_date",
    "safe_int",
    "safe_timestamp",
    "strict_date",
    "ts_literal",
    "typed_null",
    "with_default",
]
