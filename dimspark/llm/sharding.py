"""Sharding with the same mixture of sources in every shard (operator 8).

Rows are shuffled by a seeded hash and ranked within their source. Sorting all
rows by their fractional rank, the place in the source divided by the source's
size, interleaves the sources in proportion, so that any contiguous cut has the
mixture of the whole. Shards are such cuts, with row counts at most one apart.
Both sorts are range sorts whose borders are bridged by per-slice counts.

Defined results: a NULL text counts no bytes and has the checksum of no bytes; a
NULL source is a source; equal rows may swap places; an empty table gives an empty
result; an input column named like an added one is replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimspark.llm.slices import with_number, with_rank
from dimspark.llm.text import ROW, packed, random_key, unpacked, whole_text
from dimspark.operators.ordering import order_rows
from dimspark.sources.shared import scratch

ADDED = ["shard", "slot"]


def shard(
    docs: DataFrame,
    shards: int = 16,
    seed: int = 42,
    identity: str = "doc_id",
    text: str = "text",
    source: str = "source",
    key: str | None = None,
) -> DataFrame:
    """``docs`` with ``shard`` and ``slot``, the gapless place in the shard.

    ``key`` names a column with a random key of the row, if there is one already.
    """
    rows = docs.select(
        packed(docs),
        F.col(source).alias("_source"),
        (F.col(key) if key else random_key(seed, F.col(identity), whole_text(text))).alias("_key"),
    )
    by_source = [F.col("_source").isNull(), F.col("_source"), F.col("_key")]
    share = ((F.col("_rank") + F.lit(0.5)) / F.col("_of")).alias("_share")
    # The first order is needed only until the second is written.
    with scratch(docs.sparkSession) as first:
        ranked = with_rank(order_rows(rows, by_source), "_source", "_rank", "_of")
        with first.suspended():
            interleaved = order_rows(ranked.select(ROW, "_source", "_key", share), [F.col("_share"), *by_source])
    placed = with_number(interleaved, "_number", "_rows")
    cut = placed.withColumn("shard", F.expr(f"cast((_number * {shards}) div _rows as int)"))
    # Shard s begins at the smallest number n with n * shards >= s * rows.
    begins = F.expr(f"(shard * _rows + {shards - 1}) div {shards}")
    return cut.withColumn("slot", (F.col("_number") - begins).cast("long")).select(*unpacked(docs.columns, ADDED))
