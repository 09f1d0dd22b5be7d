"""Tables cut into parts by a hash of a key, and changed part by part.

The parts are partitions of a parquet table, in a column whose name tells their
number, ``part_of_64``. A change reads and replaces the parts that hold a changed key
and leaves the files of all others. What a part becomes is written in the shared
folder first, so that no part is read while it is replaced and lost executors repeat
no half of a change. Spark replaces each part by a rename. A driver that dies between
two of them leaves some parts changed; the changes here can simply be made again.

A row whose key is NULL belongs to no key. Such rows are spread by a hash of the row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimspark.sources.shared import delete, store

_PREFIX = "part_of_"
PARTS = 64


def part_column(df: DataFrame) -> str:
    """The name of the column that holds the part."""
    return next(c for c in df.columns if c.startswith(_PREFIX))


def _part(df: DataFrame, keys: Sequence[str], parts: int) -> Column:
    hashable = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    of = F.when(missing, F.xxhash64(*hashable)).otherwise(F.xxhash64(*keys))
    return F.pmod(of, F.lit(parts)).cast("int")


def with_part(df: DataFrame, keys: Sequence[str], table: DataFrame) -> DataFrame:
    """``df`` with the part that each row has in ``table``, and with the table's types.

    Hashes depend on the type, so types are made equal first.
    """
    column = part_column(table)
    alike = df.select(*[F.col(c).cast(table.schema[c].dataType).alias(c) for c in df.columns])
    return alike.withColumn(column, _part(alike, keys, int(column.removeprefix(_PREFIX))))


def read_parts(spark: SparkSession, path: str) -> DataFrame | None:
    """The table with its part column; None if there is none."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        # A folder in which no row has been written has no schema.
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def whole(table: DataFrame) -> DataFrame:
    """The table without its part column."""
    return table.drop(part_column(table))


def _write(df: DataFrame, column: str, path: str) -> None:
    # Rebalancing gives each part few files, and a part with very many rows several tasks.
    balanced = df.hint("rebalance", F.col(column))
    balanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def write_parts(df: DataFrame, path: str, keys: Sequence[str], parts: int = PARTS) -> DataFrame:
    """Write a new table in ``parts`` parts, and return it; ``df`` must not read ``path``."""
    delete(df.sparkSession, path)
    column = f"{_PREFIX}{parts}"
    _write(df.withColumn(column, _part(df, keys, parts)), column, path)
    table = read_parts(df.sparkSession, path)
    return df.sparkSession.createDataFrame([], df.schema) if table is None else whole(table).select(*df.columns)


def parts_of(rows: DataFrame) -> list[int]:
    """The parts that occur in ``rows``: as many values as the table has parts, at most."""
    return sorted(r[0] for r in rows.select(part_column(rows)).distinct().collect())


def replace_parts(spark: SparkSession, path: str, parts: Sequence[int], rows: DataFrame) -> None:
    """Make ``rows``, which have the part column, all that is in ``parts``."""
    column = part_column(rows)
    ready = store(rows)
    _write(ready, column, path)
    for part in set(parts) - set(parts_of(ready)):
        delete(spark, f"{path.rstrip('/')}/{column}={part}")
