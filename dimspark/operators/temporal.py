"""Point-in-time joins, and the newest row per key."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimspark.functions.periods import covers_closed_open
from dimspark.operators.histories import History, covering_versions, measure, periods
from dimspark.operators.joins import same_id
from dimspark.sources.shared import store


def point_in_time_join(
    left: DataFrame,
    right: DataFrame,
    on: tuple[str, str],
    at: str,
    start: str = "valid_from",
    end: str = "valid_to",
    how: Literal["left", "inner"] = "left",
    history: History | None = None,
) -> DataFrame:
    """Join ``left`` to the ``right`` versions whose ``[start, end)`` covers ``left[at]``.

    ``on`` names the id in ``left`` and in ``right``. The result has the columns
    of ``left`` and those of ``right`` without its id and period; the names must
    not clash. Overlapping periods and repeated versions multiply rows.

    Short histories are joined on the id, and the planner broadcasts ``right`` if
    its size allows. With long ones that would compare each row with the whole
    history of its id, so the versions in force are found from a sorted order. Only
    ids, periods and a number go through it; the number, which is written with
    the version, tells versions apart that are equal in everything else.
    ``history`` is measured unless given; several can be measured in one job.
    """
    left_id, right_id = on
    payload = [c for c in right.columns if c not in (right_id, start, end)]
    if history is None:
        history = measure({"right": periods(right, right_id, start, end)})["right"]

    if history.short(left.sparkSession):
        versions = right.withColumnsRenamed({right_id: "_vid", start: "_start", end: "_end"})
        in_force = covers_closed_open(F.col(at), F.col("_start"), F.col("_end"))
        return left.join(versions, same_id(left, left_id, "_vid") & in_force, how).select(*left.columns, *payload)

    left = store(left)
    versions = store(right.withColumn("_n", F.monotonically_increasing_id()))
    narrow = versions.select(
        F.col(right_id).alias("_id"), F.struct(F.col(start).alias("start"), F.col(end).alias("end"), "_n").alias("_version")
    )
    moments = left.select(F.col(left_id).alias("_id"), F.col(at).alias("_at")).dropna().distinct()
    found = covering_versions(moments, narrow, covers_closed_open, inclusive=True)
    matches = found.select("_id", "_at", F.col("_version._n").alias("_n")).join(versions.select("_n", *payload), "_n")
    same_moment = same_id(left, left_id, "_id") & (F.col(at) == F.col("_at"))
    return left.join(matches, same_moment, how).select(*left.columns, *payload)


def scd1_latest(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The row of each key that is last by ``order``, then by the other columns.

    A maximum is combined within each task before the shuffle, so a busy key
    costs one row per task; a ranking window would gather all of its rows.
    """
    others = [c for c in df.columns if c != key and c not in order]
    newest = df.groupBy(key).agg(F.max(F.struct(*order, *others)).alias("_row"))
    return newest.select(*[F.col(key) if c == key else F.col("_row").getField(c).alias(c) for c in df.columns])
