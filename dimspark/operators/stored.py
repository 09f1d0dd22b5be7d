"""Versioned dimensions that are stored, and change in place.

A stored dimension has two tables: its rows, in parts by a hash of the natural id
(``dimspark.sources.parts``), and its keys, which only grows: (id, start, copy) and
the key given to it. ``copy`` numbers versions with equal id and start. A version that
has been given a key keeps it, whatever is loaded, spliced or rebuilt later.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dimspark.operators.ordering import SLICE, place_in_slice
from dimspark.operators.versions import closed_rows, dense_key
from dimspark.sources.loads import append_load, read_loads
from dimspark.sources.parts import PARTS, part_column, parts_of, read_parts, replace_parts, whole, with_part, write_parts
from dimspark.sources.shared import store

_COPY = "copy"


def _same(left: DataFrame, right: DataFrame, columns: dict[str, str]) -> Column:
    """Condition that columns of both are equal, NULLs too."""
    condition = F.lit(True)
    for a, b in columns.items():
        condition = condition & left[a].eqNullSafe(right[b])
    return condition


def _with_copy(rows: DataFrame, key: str, start: str) -> DataFrame:
    """Ordered rows with the number of earlier rows that have their id and start.

    Such rows are neighbours, so within a slice the number is a distance; only one row
    for each slice and group goes through a window.
    """
    groups = Window.partitionBy("_id", "_start")
    spans = (
        rows.groupBy(F.col(SLICE).alias("_on"), F.col(key).alias("_id"), F.col(start).alias("_start"))
        .agg(F.count("*").alias("_n"), F.min(place_in_slice()).alias("_first"))
        .withColumn("_earlier", F.sum("_n").over(groups.orderBy("_on").rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("_all", F.sum("_n").over(groups))
        .where("_all > 1")
    )
    same = (F.col(SLICE) == F.col("_on")) & F.col(key).eqNullSafe(F.col("_id")) & F.col(start).eqNullSafe(F.col("_start"))
    copy = F.coalesce(place_in_slice() - F.col("_first") + F.coalesce("_earlier", F.lit(0)), F.lit(0))
    return rows.join(spans, same, "left").withColumn(_COPY, copy.cast("bigint"))


def stable_dimension(
    versions: DataFrame,
    key: str,
    key_name: str,
    known: DataFrame | None = None,
    start: str = "valid_from",
    ties: Sequence[str] | None = None,
    end: str = "valid_to",
    above: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """A dimension whose keys survive a rebuild, and the rows that the table of keys gains.

    ``known``: (``key``, ``start``, ``copy``, ``key_name``) of all keys given so far. A
    version found there keeps its key; only others get new ones, which continue from
    the greatest (``above`` if given) in the order of id, start and ties.
    """
    order, open_columns = closed_rows(versions, key, start, ties, end)
    rows = _with_copy(order, key, start).select(*open_columns, end, _COPY, F.col("_number"))
    if known is None:
        given = rows.withColumn(key_name, (F.col("_number") + 1).cast("bigint"))
        new = given
    else:
        rows = store(rows)
        seen = known.select(F.col(key).alias("_id"), F.col(start).alias("_start"), F.col(_COPY).alias("_copy"), F.col(key_name).alias("_key"))
        joined = store(rows.join(seen, _same(rows, seen, {key: "_id", start: "_start", _COPY: "_copy"}), "left"))
        if above is None:
            above = known.agg(F.max(key_name)).first()[0] or 0
        unseen = joined.where("_key IS NULL").select(*rows.columns)
        new = dense_key(unseen, ["_number"], key_name, above=F.lit(above).cast("bigint"))
        old = joined.where("_key IS NOT NULL").withColumn(key_name, F.col("_key"))
        given = old.select(*new.columns).unionByName(new)
    return given.select(key_name, *open_columns, end), new.select(key, start, _COPY, key_name)


def _paths(path: str) -> tuple[str, str]:
    return f"{path.rstrip('/')}/rows", f"{path.rstrip('/')}/keys"


def read_dimension(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored dimension at ``path``; None if there is none."""
    table = read_parts(spark, _paths(path)[0])
    return None if table is None else whole(table)


def rebuild_dimension(
    spark: SparkSession,
    path: str,
    versions: DataFrame,
    key: str,
    key_name: str,
    start: str = "valid_from",
    ties: Sequence[str] | None = None,
    end: str = "valid_to",
    parts: int = PARTS,
) -> DataFrame:
    """Build the dimension at ``path`` anew from all source ``versions``; keys given before stay.

    New keys are stored before the rows that use them: an interrupted rebuild leaves
    keys without rows, which the next one uses.
    """
    rows_path, keys_path = _paths(path)
    dimension, new = stable_dimension(versions, key, key_name, read_loads(spark, keys_path), start, ties, end)
    dimension, new = store(dimension), store(new)
    if not new.isEmpty():
        append_load(new, keys_path)
    return write_parts(dimension, rows_path, [key], parts)


def _by_id(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """The number of versions of each id, and sums of two hashes of them: equal for equal collections."""
    rest = [F.col(c) for c in columns]
    return df.groupBy(F.col(key).alias("_id")).agg(
        F.count("*").alias("_n"),
        F.sum(F.xxhash64(*rest).cast("decimal(20,0)")).alias("_a"),
        F.sum(F.xxhash64(F.lit("other"), *rest).cast("decimal(20,0)")).alias("_b"),
    )


def changed_ids(stored: DataFrame, versions: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Ids (as ``_id``) whose stored versions are not those of the source, wherever the difference lies.

    Both sides are combined within the tasks to one row for each id before they are
    shuffled, so a busy id costs no more than others.
    """
    before, now = _by_id(stored, key, columns), _by_id(versions, key, columns)
    both = before.withColumnsRenamed({c: f"{c}_before" for c in before.columns}).join(
        now, F.col("_id_before").eqNullSafe(F.col("_id")), "full"
    )
    equal = F.col("_n_before").eqNullSafe(F.col("_n")) & F.col("_a_before").eqNullSafe(F.col("_a")) & F.col("_b_before").eqNullSafe(F.col("_b"))
    return both.where(~equal).select(F.when(F.col("_n").isNull(), F.col("_id_before")).otherwise(F.col("_id")).alias("_id"))


def splice_dimension(
    spark: SparkSession,
    path: str,
    versions: DataFrame,
    key: str,
    key_name: str,
    start: str = "valid_from",
    ties: Sequence[str] | None = None,
    end: str = "valid_to",
    parts: int = PARTS,
) -> DataFrame:
    """Bring the dimension at ``path`` to what a rebuild from all source ``versions`` gives.

    Late versions are found wherever they fall: ids are compared, not times. Only ids
    that differ are read from the source, closed and numbered again, and only the parts
    that hold them are written. An id that the source no longer has goes. Without a
    stored table this is a first build; without a difference nothing is written.
    """
    rows_path, keys_path = _paths(path)
    table = read_parts(spark, rows_path)
    if table is None:
        return rebuild_dimension(spark, path, versions, key, key_name, start, ties, end, parts)
    open_columns = [c for c in versions.columns if c != end]
    alike = versions.select(*[F.col(c).cast(table.schema[c].dataType).alias(c) for c in open_columns])
    changed = store(changed_ids(whole(table), alike, key, [c for c in open_columns if c != key]))
    if changed.isEmpty():
        return whole(table)

    def only(df: DataFrame, how: str) -> DataFrame:
        return df.join(changed, df[key].eqNullSafe(changed["_id"]), how)

    keys = read_loads(spark, keys_path)
    highest = keys.agg(F.max(key_name)).first()[0] or 0
    dimension, new = stable_dimension(only(alike, "left_semi"), key, key_name, only(keys, "left_semi"), start, ties, end, highest)
    dimension, new = store(dimension), store(new)
    if not new.isEmpty():
        append_load(new, keys_path)
    # A row without an id lies in a part of its own hash, so all parts may hold one.
    column = part_column(table)
    nulls = not changed.where("_id IS NULL").isEmpty()
    touched = with_part(changed.where("_id IS NOT NULL").select(F.col("_id").alias(key)), [key], table)
    affected = list(range(int(column.rsplit("_", 1)[1]))) if nulls else parts_of(touched)
    kept = only(table.where(F.col(column).isin(affected)), "left_anti")
    replace_parts(spark, rows_path, affected, kept.unionByName(with_part(dimension, [key], table)))
    return read_dimension(spark, path)


def overwrite_attributes(spark: SparkSession, path: str, changes: DataFrame, key: str) -> DataFrame:
    """Type 1 changes: give all versions of an id the attributes that ``changes`` has for it.

    ``changes`` has one row for each id, with the attributes to overwrite, NULLs too.
    No version is added and no period changes. Ids without a version are ignored; two
    changes of one id are an error.
    """
    rows_path = _paths(path)[0]
    table = read_parts(spark, rows_path)
    if table is None:
        raise ValueError(f"there is no dimension at {path}")
    column = part_column(table)
    attributes = [c for c in changes.columns if c != key]
    fresh = store(with_part(changes.dropna(subset=[key]), [key], table))
    repeated = fresh.groupBy(key).count().where("count > 1").select(key).first()
    if repeated is not None:
        raise ValueError(f"several changes have the id {repeated[0]}")
    parts = parts_of(fresh)
    if parts:
        new = fresh.select(F.col(key).alias("_id"), F.struct(*attributes).alias("_new"))
        joined = table.where(F.col(column).isin(parts)).join(new, F.col(key) == F.col("_id"), "left")
        values = [
            F.when(F.col("_new").isNotNull(), F.col("_new").getField(c)).otherwise(F.col(c)).alias(c) if c in attributes else F.col(c)
            for c in table.columns
        ]
        replace_parts(spark, rows_path, parts, joined.select(*values))
    return read_dimension(spark, path)
