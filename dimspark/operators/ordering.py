"""A total order over a DataFrame, cut into slices of even size.

``Window.orderBy`` without a partition sorts a whole table in one task, and
``Window.partitionBy(id)`` puts all rows of a busy id there. Both are avoided by
sorting across range partitions ("slices"): sampled bounds over *all* order
columns split a busy id by time, ties and origin, so no slice depends on how
many rows one id has. What a row needs from its neighbours is found while the
sorted rows are written, without a further shuffle; what crosses a slice border is
then carried by a table with one row per slice, small enough to broadcast
whatever the data.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimspark.sources.shared import store

# monotonically_increasing_id() holds the partition above this bit and the row's
# place in its partition below.
_PLACE_BITS = 33

SLICE = "_slice"
POSITION = "_position"

# A column's name, and a function of the columns of a slice's sorted rows that gives its values.
Scan = tuple[str, Column]


def order_rows(df: DataFrame, order: Sequence[Column], scan: Scan | None = None) -> DataFrame:
    """``df`` sorted by ``order`` (NULLs first), with ``_slice`` and ``_position``.

    ``_position`` grows along the total order. The result is a written table:
    range bounds are sampled, so a second evaluation could cut differently, and
    all readers must see the same slices. The last order column is the number of
    the input partition: it spreads exact copies, and unlike a random number it
    is the same when a lost task runs again. ``scan`` adds a column to the sorted
    rows of each slice on their way; only the columns it reads pass through Python.
    """
    keys = [F.asc_nulls_first(c) for c in (*order, F.col("_origin"))]
    placed = (
        df.withColumn("_origin", F.spark_partition_id())
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .drop("_origin")
        .withColumn(POSITION, F.monotonically_increasing_id())
    )
    if scan is not None:
        placed = placed.withColumn(*scan)
    return store(placed).withColumn(SLICE, F.shiftright(POSITION, _PLACE_BITS))


def place_in_slice() -> Column:
    """Zero-based place of a row in its slice."""
    return F.col(POSITION).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))


def across_slices() -> Window:
    """Window over a table with one row per slice.

    It has no partition, which is right only because that table has as many rows
    as the range shuffle had partitions.
    """
    return Window.orderBy(SLICE)


def _same(a: pa.Array, b: pa.Array) -> pa.Array:
    """Equal, or both NULL."""
    both_null = pc.and_(pc.is_null(a), pc.is_null(b))
    return pc.or_(both_null, pc.fill_null(pc.equal(a, b), False))


def next_of_key(key: str, start: T.StructField) -> Scan:
    """``_next``: a struct with the ``start`` of the next row if that has the same ``key``, else NULL."""
    kind = T.StructType([T.StructField("start", start.dataType)])

    @F.arrow_udf(kind)
    def following(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        def marked(keys: pa.Array, starts: pa.Array, after: tuple[pa.Array, pa.Array] | None) -> pa.Array:
            def shifted(own: pa.Array, first: pa.Array | None) -> pa.Array:
                return pa.concat_arrays([own.slice(1), pa.nulls(1, own.type) if first is None else first])

            next_key, next_start = (a.slice(0, 1) for a in after) if after else (None, None)
            same = _same(keys, shifted(keys, next_key)).to_numpy(zero_copy_only=False).copy()
            if after is None:
                same[-1] = False
            return pa.StructArray.from_arrays([shifted(starts, next_start)], names=["start"], mask=pa.array(~same))

        held = None
        for batch in batches:
            if len(batch[0]):
                if held is not None:
                    yield marked(*held, batch)
                held = batch
        if held is not None:
            yield marked(*held, None)

    # What a row gets depends on its place, so the function must stay behind the sort.
    return "_next", following.asNondeterministic()(F.col(key), F.col(start.name))


def last_of_key(key: str, value: T.StructField) -> Scan:
    """``_seen``: the last ``value`` that is not NULL among this row and those of its ``key`` before it."""

    @F.arrow_udf(value.dataType)
    def seen(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        import numpy as np

        kept: tuple[pa.Array, pa.Array] | None = None  # key and value of the last row that had one
        for keys, values in batches:
            has = pc.is_valid(values).to_numpy(zero_copy_only=False)
            places = np.maximum.accumulate(np.where(has, np.arange(1, len(has) + 1), 0))
            before = kept or (pa.nulls(1, keys.type), pa.nulls(1, values.type))
            at = pa.array(places)
            of_key = pa.concat_arrays([before[0], keys]).take(at)
            found = pa.concat_arrays([before[1], values]).take(at)
            yield pc.if_else(_same(of_key, keys), found, pa.nulls(len(found), found.type))
            if len(places) and places[-1]:
                last = int(places[-1]) - 1
                kept = keys.slice(last, 1), values.slice(last, 1)

    return "_seen", seen.asNondeterministic()(F.col(key), F.col(value.name))
