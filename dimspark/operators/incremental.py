"""Watermark filter, merge and incremental loading of a versioned dimension."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Literal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimspark.functions.scalars import END_OF_TIME, START_OF_TIME, ts_literal
from dimspark.operators.versions import version_dimension
from dimspark.sources.loads import append_load, read_loads
from dimspark.sources.parts import PARTS, part_column, parts_of, read_parts, replace_parts, whole, with_part, write_parts
from dimspark.sources.shared import store


def watermark(df: DataFrame, col: str, floor: Column) -> DataFrame:
    """One row: the greatest ``col``, or ``floor`` if there is none."""
    return df.agg(F.coalesce(F.max(col), floor).alias(col))


def incremental_filter(df: DataFrame, target: DataFrame, col: str) -> DataFrame:
    """Rows of ``df`` above the greatest ``col`` in the whole target; NULLs drop out."""
    high = watermark(target, col, ts_literal(START_OF_TIME)).scalar()
    return df.where(F.col(col) > high)


def merge_upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` with matched rows replaced and the other updates added.

    A NULL key matches nothing. Two updates of one key are an error, as it would be
    left to chance which one stays; they are looked for before anything is merged.
    """
    known = updates.dropna(subset=list(keys))
    repeated = known.groupBy(*keys).count().where("count > 1").select(*keys).first()
    if repeated is not None:
        raise ValueError(f"several updates have the key {repeated.asDict()}")
    kept = target.join(updates.select(*keys), list(keys), "left_anti").select(*target.columns)
    return kept.unionByName(updates)


def merge_table(spark: SparkSession, path: str, updates: DataFrame, keys: Sequence[str], parts: int = PARTS) -> DataFrame:
    """``merge_upsert`` into the table in parts at ``path``, in place; returns the table.

    Only parts that hold an updated key are read and written. Without a table the
    updates become one, in ``parts`` parts. Merging the same updates again changes
    nothing but rows without a key, which match nothing.
    """
    table = read_parts(spark, path)
    if table is None:
        nothing = spark.createDataFrame([], updates.schema)
        return write_parts(merge_upsert(nothing, store(updates), keys), path, keys, parts)
    column = part_column(table)
    changes = store(with_part(updates.select(*whole(table).columns), keys, table))
    affected = parts_of(changes)
    if affected:
        replace_parts(spark, path, affected, merge_upsert(table.where(F.col(column).isin(affected)), changes, keys))
    return whole(read_parts(spark, path))


def _high_marks(target: DataFrame, start: str, key_name: str) -> tuple[Column, Column]:
    """The greatest start and key of a stored dimension, with their floors, found in one scan."""
    row = target.agg(
        F.coalesce(F.max(start), ts_literal(START_OF_TIME)).cast("string"), F.coalesce(F.max(key_name), F.lit(0).cast("bigint"))
    ).first()
    return ts_literal(row[0]), F.lit(row[1]).cast("bigint")


def new_versions(
    target: DataFrame,
    versions: DataFrame,
    key: str,
    key_name: str,
    start: str = "valid_from",
    end: str = "valid_to",
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """The rows that a load of all source ``versions`` adds to a stored dimension.

    Only versions that start after every stored one are new; their keys continue
    from the greatest stored key. A version that late is only ever followed by one
    as late, so the filter comes first and periods are closed over the new versions
    alone. None of them can match a stored (key, start), so the keyed merge comes
    down to an append.
    """
    last_start, last_key = _high_marks(target, start, key_name)
    return version_dimension(versions.where(F.col(start) > last_start), key, key_name, start, ties, end, above=last_key)


def incremental_scd2(
    target: DataFrame | None,
    versions: DataFrame,
    key: str,
    key_name: str,
    start: str = "valid_from",
    end: str = "valid_to",
    ties: Sequence[str] | None = None,
    mode: Literal["append_only", "close_previous"] = "append_only",
) -> DataFrame:
    """The new content of a versioned dimension after a load of all source ``versions``.

    Without a target all versions are loaded, else the ``new_versions``.
    ``append_only`` leaves the formerly current version open, where it overlaps
    its successor; ``close_previous`` ends it at the first new start.
    """
    if target is None:
        return version_dimension(versions, key, key_name, start, ties, end)
    added = new_versions(target, versions, key, key_name, start, end, ties)
    stored = target
    if mode == "close_previous":
        successor = added.groupBy(F.col(key).alias("_id")).agg(F.min(start).alias("_successor"))
        still_open = F.col(end) == ts_literal(END_OF_TIME)
        stored = target.join(successor, F.col(key) == F.col("_id"), "left").withColumn(
            end, F.when(still_open, F.coalesce("_successor", end)).otherwise(F.col(end))
        )
    return stored.select(*added.columns).unionByName(added)


def load_scd2(
    spark: SparkSession,
    path: str,
    versions: DataFrame,
    key: str,
    key_name: str,
    start: str = "valid_from",
    end: str = "valid_to",
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """Load all source ``versions`` into the dimension at ``path``, and return it.

    Only new rows are written, as one load; stored rows are read once, for the
    greatest start and key. Without new versions nothing is written.
    """
    target = read_loads(spark, path)
    if target is None:
        return append_load(version_dimension(versions, key, key_name, start, ties, end), path)
    last_start, last_key = _high_marks(target, start, key_name)
    new = versions.where(F.col(start) > last_start)
    if new.isEmpty():
        return target
    added = version_dimension(new, key, key_name, start, ties, end, above=last_key)
    return append_load(added.select(*target.columns), path)
