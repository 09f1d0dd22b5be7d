"""Places and running totals over a table sorted into slices.

``order_rows`` (see its module) sorts a table across range partitions. The tables
joined here have one row per slice, or one per slice and group. The second kind has
no proven size; it is written, so that the planner knows its size and broadcasts it
only if that is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimspark.operators.ordering import POSITION, SLICE, across_slices, place_in_slice
from dimspark.sources.shared import store

_EARLIER = (Window.unboundedPreceding, -1)


def with_number(ordered: DataFrame, number: str, total: str | None = None) -> DataFrame:
    """``ordered`` with the zero-based number of each row and, if asked, the number of rows."""
    everything = across_slices().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = (
        ordered.groupBy(SLICE)
        .agg(F.count("*").alias("_n"))
        .select(
            SLICE,
            F.coalesce(F.sum("_n").over(across_slices().rowsBetween(*_EARLIER)), F.lit(0)).alias("_before"),
            F.sum("_n").over(everything).alias("_all"),
        )
    )
    extra = [F.col("_all").alias(total)] if total else []
    return ordered.join(F.broadcast(before), SLICE).select(
        *ordered.columns, (F.col("_before") + place_in_slice()).alias(number), *extra
    )


def _joined(ordered: DataFrame, spans: DataFrame, group: str) -> DataFrame:
    spans = store(spans.withColumnsRenamed({SLICE: "_on_slice", group: "_on_group"}))
    same = (F.col(SLICE) == F.col("_on_slice")) & F.col(group).eqNullSafe(F.col("_on_group"))
    return ordered.join(spans, same).drop("_on_slice", "_on_group")


def with_rank(ordered: DataFrame, group: str, rank: str, total: str) -> DataFrame:
    """The zero-based rank of each row in its group, and the group's rows.

    The table is sorted by group first. A group's rows are neighbours, so a rank
    is the distance from the group's first row in the slice; no window over rows.
    """
    by_group = Window.partitionBy(group)
    spans = (
        ordered.groupBy(SLICE, group)
        .agg(F.count("*").alias("_n"), F.min(place_in_slice()).alias("_first"))
        .select(
            SLICE,
            group,
            "_first",
            F.coalesce(F.sum("_n").over(by_group.orderBy(SLICE).rowsBetween(*_EARLIER)), F.lit(0)).alias("_before"),
            F.sum("_n").over(by_group).alias("_all"),
        )
    )
    return _joined(ordered, spans, group).select(
        *ordered.columns,
        (F.col("_before") + place_in_slice() - F.col("_first")).alias(rank),
        F.col("_all").alias(total),
    )


def with_sum_before(ordered: DataFrame, group: str, value: Column, before: str) -> DataFrame:
    """The sum of ``value`` over the rows of the same group that come earlier."""
    spans = (
        ordered.groupBy(SLICE, group)
        .agg(F.sum(value).alias("_n"))
        .select(
            SLICE,
            group,
            F.coalesce(
                F.sum("_n").over(Window.partitionBy(group).orderBy(SLICE).rowsBetween(*_EARLIER)), F.lit(0)
            ).alias("_before"),
        )
    )
    in_slice = Window.partitionBy(SLICE, group).orderBy(POSITION).rowsBetween(*_EARLIER)
    return _joined(ordered, spans, group).select(
        *ordered.columns, (F.col("_before") + F.coalesce(F.sum(value).over(in_slice), F.lit(0))).alias(before)
    )
