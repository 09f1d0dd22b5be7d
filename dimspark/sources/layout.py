"""Layouts that spare later readers work: buckets of a join key, and partitions by month.

Header and line tables in equally many buckets of their common id are joined without a
shuffle. A bucket is read by one task, so buckets suit ids with few rows each, as an
order has lines; an id with a large share of all rows is better joined by a shuffle,
which adaptive execution splits.

A fact in partitions by month of its date key is read in part where a query names
days, months or quarters through the date dimension: ``month_key`` is in both tables,
and a join on it lets the dimension's filter choose the partitions at run time.

A table of the catalog with statistics of all its columns lets ``by_cost`` order the
joins of an ad-hoc query by what they leave, not by how they are written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MONTH = "month_key"


def write_bucketed(df: DataFrame, name: str, path: str, column: str, buckets: int) -> DataFrame:
    """Write ``df`` to ``path`` as the catalog's table ``name``, in sorted buckets of ``column``, and return it."""
    # One task writes a bucket, so that it is one file.
    cut = df.repartition(buckets, column).write.format("parquet").mode("overwrite").option("path", path)
    cut.bucketBy(buckets, column).sortBy(column).saveAsTable(name)
    return df.sparkSession.table(name)


def month_key(day: Column) -> Column:
    """The month of a date as a number, 199802; NULL without a date."""
    return (F.year(day) * 100 + F.month(day)).cast("int")


def write_monthly(df: DataFrame, path: str, day: str) -> DataFrame:
    """Replace the table at ``path`` by ``df`` in partitions by month of ``day``, and return it with ``month_key``.

    A month with very many rows is written by several tasks, months with few share
    one. Rows without a day have a partition of their own.
    """
    dated = df.withColumn(MONTH, month_key(F.col(day)))
    balanced = dated.hint("rebalance", F.col(MONTH)).write.mode("overwrite").partitionBy(MONTH)
    balanced.parquet(path)
    return read_monthly(df.sparkSession, path, dated)


def read_monthly(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The table at ``path`` with the columns of ``like``."""
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)


def write_analyzed(df: DataFrame, name: str, path: str) -> DataFrame:
    """Write ``df`` to ``path`` as the catalog's table ``name``, with statistics of all columns, and return it.

    Types without statistics, such as arrays and maps, leave the rows and bytes only.
    """
    spark = df.sparkSession
    df.write.format("parquet").mode("overwrite").option("path", path).saveAsTable(name)
    nested = any(kind.startswith(("array", "map", "struct")) for _, kind in df.dtypes)
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS" + ("" if nested else " FOR ALL COLUMNS"))
    return spark.table(name)


def by_cost(spark: SparkSession, query: str) -> DataFrame:
    """``spark.sql(query)``, its joins ordered by the statistics of the tables; the session's settings stay."""
    settings = {"spark.sql.cbo.enabled": "true", "spark.sql.cbo.joinReorder.enabled": "true"}
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        result = spark.sql(query)
        result._jdf.queryExecution().optimizedPlan()  # kept by the DataFrame
        return result
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
