"""The row-number-and-rejoin shape of a key lookup, for comparison in ``bench.py`` only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dimspark.checks.queries import customer_dim, shipped_lines
from dimspark.functions.periods import covers_open_closed
from dimspark.sources import store


def literal_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = store(customer_dim(spark, sf_dir))
    # The handle must not change between the two uses of the fact.
    lines = store(shipped_lines(spark, sf_dir).withColumn("row_id", F.monotonically_increasing_id()))
    matched = lines.join(
        dim,
        (F.col("customer_id") == F.col("o_custkey"))
        & covers_open_closed(F.col("l_shipdate"), F.col("valid_from"), F.col("valid_to")),
        "left",
    )
    newest = Window.partitionBy("row_id").orderBy(F.desc("valid_from"))
    best = matched.select("row_id", "version_key", F.row_number().over(newest).alias("rn")).where("rn = 1")
    return lines.join(best, "row_id", "left").select(
        *lines.columns, F.coalesce("version_key", F.lit(0)).alias("customer_key")
    )
