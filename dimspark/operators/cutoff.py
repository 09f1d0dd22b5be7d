"""Load windows, stored cutoffs and run ids."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimspark.functions.scalars import ts_literal
from dimspark.operators.incremental import merge_upsert
from dimspark.sources.loads import append_load, read_loads


def cutoff_window(df: DataFrame, col: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows with ``start < col <= end``; a blank bound is no bound."""
    if start:
        df = df.where(F.col(col) > ts_literal(start))
    if end:
        df = df.where(F.col(col) <= ts_literal(end))
    return df


def update_cutoff(state: DataFrame, reached: DataFrame) -> DataFrame:
    """``state`` (table_name, cutoff_time) with the cutoffs in ``reached`` stored."""
    return merge_upsert(state, reached, ["table_name"])


def with_lineage(df: DataFrame, run_id: int) -> DataFrame:
    return df.withColumn("lineage_key", F.lit(run_id).cast("bigint"))


def stored_cutoff(spark: SparkSession, state_path: str, table_name: str) -> str | None:
    """The moment up to which ``table_name`` has been loaded; None if it never was."""
    state = read_loads(spark, state_path)
    if state is None:
        return None
    return state.where(F.col("table_name") == table_name).agg(F.max("cutoff_time").cast("string")).first()[0]


def load_by_cutoff(
    spark: SparkSession, state_path: str, table_name: str, source: DataFrame, col: str, upto: str, load: Callable[[DataFrame], object]
) -> str:
    """Load the rows of ``source`` after the stored cutoff and up to ``upto``, and return the cutoff reached.

    ``load`` writes the rows it is given. Only when it has returned is the cutoff
    stored, by adding a row to the table at ``state_path``. A load that fails, or
    dies before its cutoff is stored, leaves the old one, and the next call is given
    the same rows again: ``load`` must be safe to repeat, as a merge by key is.
    """
    since = stored_cutoff(spark, state_path, table_name)
    wanted = spark.range(1).select(ts_literal(upto).cast("string")).first()[0]
    if since is not None and wanted <= since:
        return since
    load(cutoff_window(source, col, since, upto))
    reached = spark.createDataFrame([(table_name,)], "table_name string").withColumn("cutoff_time", ts_literal(upto))
    append_load(reached, state_path)
    return wanted
