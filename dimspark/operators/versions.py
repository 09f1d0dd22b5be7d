"""Version periods and dense surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimspark.functions.scalars import END_OF_TIME, ts_literal
from dimspark.operators.ordering import POSITION, SLICE, across_slices, next_of_key, order_rows, place_in_slice


def _named(columns: Sequence[str]) -> list[Column]:
    return [F.col(c) for c in columns]


def _rows_before() -> Column:
    """Number of rows in all earlier slices, over a table of slice sizes."""
    earlier = across_slices().rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("_rows").over(earlier), F.lit(0))


def _key(above: Column | int) -> Column:
    """The row's place in the whole order, counted up from ``above``."""
    return (above + F.col("_before") + place_in_slice() + 1).cast("bigint")


def dense_key(df: DataFrame, order: Sequence[str], key_name: str, above: Column | int = 0) -> DataFrame:
    """Add ``above + row_number() over (order by order)``, numbered slice by slice.

    One range shuffle, no single-task sort. ``above`` may be a scalar subquery.
    """
    rows = order_rows(df, _named(order))
    slices = rows.groupBy(SLICE).agg(F.count("*").alias("_rows")).select(SLICE, _rows_before().alias("_before"))
    return rows.join(F.broadcast(slices), SLICE).select(_key(above).alias(key_name), *df.columns)


def with_next(df: DataFrame, key: str, start: str, ties: Sequence[str]) -> DataFrame:
    """Ordered rows with ``_next``, a struct holding the start of the key's next version.

    ``_next`` is NULL for the last version of a key; a struct tells that apart
    from a next version whose start is NULL. ``_before`` counts the rows of
    earlier slices. Within a slice the next row is seen when the slice is written,
    so the one range shuffle is all. The table of slices is found here, by a job while
    the plan is built, and passes through the driver: one row for each slice.
    """
    rows = order_rows(df, _named([key, start, *ties]), next_of_key(key, df.schema[start]))
    head = F.min_by(F.struct(F.col(key).alias("key"), F.col(start).alias("start")), POSITION)
    slices = (
        rows.groupBy(SLICE)
        .agg(F.count("*").alias("_rows"), head.alias("_head"))
        .select(SLICE, _rows_before().alias("_before"), F.lead("_head").over(across_slices()).alias("_following"))
    )
    # One row per slice; every reader of the versions needs them, so they are found once.
    slices = df.sparkSession.createDataFrame(slices.collect(), slices.schema)
    following = F.when(
        F.col("_following.key").eqNullSafe(F.col(key)) & F.col("_following").isNotNull(),
        F.struct(F.col("_following.start").alias("start")),
    )
    return rows.join(F.broadcast(slices), SLICE).withColumn("_next", F.coalesce("_next", following))


def _end() -> Column:
    return F.coalesce(F.col("_next.start"), ts_literal(END_OF_TIME))


def _other_columns(df: DataFrame, *used: str) -> list[str]:
    return [c for c in df.columns if c not in used]


def scd2_close(
    df: DataFrame, key: str, start: str = "valid_from", ties: Sequence[str] | None = None, end: str = "valid_to"
) -> DataFrame:
    """Set ``end`` to the start of the key's next version, or to the end of time.

    An end date already in ``df`` is replaced, so gaps and deletions vanish.
    Versions with equal start are ordered by ``ties`` (all other columns unless
    given); all but the last get an empty period.
    """
    open_rows = df.drop(end)
    others = _other_columns(open_rows, key, start)
    rows = with_next(open_rows, key, start, others if ties is None else ties)
    return rows.select(*open_rows.columns, _end().alias(end))


def closed_rows(
    df: DataFrame, key: str, start: str = "valid_from", ties: Sequence[str] | None = None, end: str = "valid_to"
) -> tuple[DataFrame, list[str]]:
    """Ordered rows with ``end`` set, their slice and position, and ``_number``, their place in the whole order.

    Also returns the columns of ``df`` without ``end``.
    """
    open_rows = df.drop(end)
    others = _other_columns(open_rows, key, start)
    rows = with_next(open_rows, key, start, others if ties is None else ties)
    return rows.withColumn(end, _end()).withColumn("_number", F.col("_before") + place_in_slice()), open_rows.columns


def version_dimension(
    df: DataFrame,
    key: str,
    key_name: str,
    start: str = "valid_from",
    ties: Sequence[str] | None = None,
    end: str = "valid_to",
    above: Column | int = 0,
) -> DataFrame:
    """``scd2_close`` and ``dense_key`` in one pass, as both need the same order."""
    open_rows = df.drop(end)
    others = _other_columns(open_rows, key, start)
    rows = with_next(open_rows, key, start, others if ties is None else ties)
    return rows.select(_key(above).alias(key_name), *open_rows.columns, _end().alias(end))
