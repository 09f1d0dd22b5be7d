"""Left joins whose rows without an id don't meet in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scattered(column: Column, kind: T.DataType, columns: list[str]) -> Column | None:
    """``column``, with a hash of the row in place of NULL, in a type that holds both; None for other types."""
    if isinstance(kind, T.IntegralType):
        return F.coalesce(column.cast("bigint"), F.xxhash64(*columns))
    if isinstance(kind, T.DecimalType):
        # Whole digits for any hash beside the fractional digits of the id, which may be at most 18.
        return F.coalesce(column, F.xxhash64(*columns).cast("decimal(20,0)")) if kind.scale <= 18 else None
    if isinstance(kind, T.StringType):
        return F.coalesce(column, F.xxhash64(*columns).cast("string"))
    return None


def hashable(df: DataFrame) -> list[str]:
    """The columns that a hash can take: all but maps."""
    return [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]


def same_id(left: DataFrame, left_id: str, right_id: str, columns: list[str] | None = None) -> Column:
    """Condition that two ids are equal, for a left join.

    A NULL id matches nothing, yet all such rows would be shuffled to one
    partition. The first key scatters them by a hash of ``columns``, all hashable
    ones unless given; the second keeps the match exact.
    """
    plain = F.col(left_id) == F.col(right_id)
    spread = scattered(F.col(left_id), left.schema[left_id].dataType, columns or hashable(left))
    return plain if spread is None else (spread == F.col(right_id)) & plain


def left_join(left: DataFrame, right: DataFrame, left_id: str, right_id: str, spread_by: list[str]) -> DataFrame:
    """``left`` with the columns of ``right`` where the ids are equal; rows without an id are spread by ``spread_by``."""
    return left.join(right, same_id(left, left_id, right_id, spread_by), "left")
