"""Mixing sources to target weights (operator 2).

Every row gets a hash-random key. The rows are sorted by source and key across
range partitions, running totals of sizes are carried over partition borders, and
each source is cut exactly where its budget ends. A budget above the source's size
takes whole epochs first and cuts the next one. Only sizes and positions go through
the running totals; they give one cut position for each source, with which the rows
are read once more.

Defined results: a NULL text has size 0 and takes nothing; a NULL source is a
source, the last one; equal rows may swap what they take; an empty table gives an
empty result; an input column named like an added one is replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimspark.llm.slices import with_number, with_sum_before
from dimspark.llm.text import ROW, packed, random_key, unpacked, whole_text, word_count
from dimspark.operators.ordering import POSITION, SLICE, order_rows
from dimspark.sources.shared import store

ADDED = ["size", "source_size", "target", "taken"]


def _exact(column: Column) -> Column:
    return column.cast("decimal(38,0)")


def source_targets(sized: DataFrame, weights: Sequence[int], most_epochs: int) -> DataFrame:
    """(``_source``, ``source_size``, ``target``) of a (``_source``, ``size``) table.

    Sources take ``weights`` in turn, by code point. A source stops at
    ``most_epochs`` times its size, and what it leaves is shared among the others
    by weight: a round raises the common level until no further source is full.
    One round is one small aggregation, whose three sums come to the driver.
    """
    totals = store(sized.groupBy("_source").agg(F.sum("size").alias("source_size")))
    ranked = with_number(order_rows(totals, [F.col("_source").isNull(), F.col("_source")]), "_rank")
    turn = F.array(*[F.lit(int(w)) for w in weights])
    sources = store(
        ranked.select(
            "_source",
            "source_size",
            F.element_at(turn, (F.col("_rank") % len(weights) + 1).cast("int")).cast("long").alias("_weight"),
        )
    )

    def left_over(full: Column) -> tuple[int, int]:
        """The words and the weights that are left when the full sources have all they can take."""
        row = sources.agg(
            F.sum(_exact(F.col("source_size"))),
            F.sum(_exact(F.when(full, F.col("source_size") * most_epochs))),
            F.sum(F.when(~full, F.col("_weight"))),
        ).first()
        return int(row[0] or 0) - int(row[1] or 0), int(row[2] or 0)

    budget, weight = left_over(F.lit(False))
    while weight:
        due = _exact(F.col("_weight")) * F.lit(str(budget)).cast("decimal(38,0)")
        room = _exact(F.col("source_size") * most_epochs) * F.lit(str(weight)).cast("decimal(38,0)")
        left = left_over(due > room)
        if left == (budget, weight):
            break
        budget, weight = left
    most = (F.col("source_size") * most_epochs).cast("double")
    share = (F.col("_weight") * F.lit(budget)).cast("double") / F.lit(float(weight)) if weight else most
    return sources.select("_source", "source_size", F.least(most, share).alias("target"))


def _mixed(
    docs: DataFrame,
    weights: Sequence[int],
    most_epochs: int,
    seed: int,
    identity: str,
    text: str,
    source: str,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """The packed rows of ``docs`` with the added columns."""
    rows = docs.select(
        packed(docs, keep),
        F.col(source).alias("_source"),
        word_count(whole_text(text)).alias("size"),
        random_key(seed, F.col(identity), whole_text(text)).alias("_key"),
    )
    ordered = order_rows(rows, [F.col("_source").isNull(), F.col("_source"), F.col("_key")])
    narrow = ordered.select(SLICE, POSITION, "_source", "size")
    targets = source_targets(narrow.select("_source", "size"), weights, most_epochs)
    budgets = targets.withColumn("_goal", F.floor("target")).withColumns(
        {
            "_epochs": F.expr("if(source_size = 0, 0, _goal div source_size)"),
            "_rest": F.expr("if(source_size = 0, 0, _goal % source_size)"),
        }
    )
    budgets = store(budgets.select(F.col("_source").alias("_of"), "source_size", "target", "_epochs", "_rest"))
    # The cut of a source is the one row that its rest reaches but doesn't exceed.
    of_source = F.col("_source").eqNullSafe(F.col("_of"))
    placed = with_sum_before(narrow, "_source", F.col("size"), "_before_it").join(budgets, of_source)
    reached = (F.col("_before_it") <= F.col("_rest")) & (F.col("_rest") < F.col("_before_it") + F.col("size"))
    cuts = placed.where(reached).select("_of", F.col(POSITION).alias("_cut"), (F.col("_rest") - F.col("_before_it")).alias("_part"))
    # One row for each source, joined to the rows in whatever way their size asks for.
    plan = store(
        budgets.join(cuts.withColumnRenamed("_of", "_at"), F.col("_of").eqNullSafe(F.col("_at")), "left").select(
            "_of", "source_size", "target", "_epochs", "_cut", "_part"
        )
    )
    place = F.col(POSITION)
    last = F.when(place < F.col("_cut"), F.col("size")).when(place == F.col("_cut"), F.col("_part")).otherwise(0)
    taken = (F.col("_epochs") * F.col("size") + last).cast("long")
    return ordered.join(plan, of_source).select(ROW, "size", "source_size", "target", taken.alias("taken"))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = (1, 2, 3),
    most_epochs: int = 3,
    seed: int = 42,
    identity: str = "doc_id",
    text: str = "text",
    source: str = "source",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``taken`` words.

    ``taken`` counts repeats. The taken words of a source sum to its target,
    rounded down; the row at the cut is taken in part. ``keep`` names the columns
    to carry through the sort, all if it is None.
    """
    mixed = _mixed(docs, weights, most_epochs, seed, identity, text, source, keep)
    return mixed.select(*unpacked(keep or docs.columns, ADDED))


def mixed_documents(
    docs: DataFrame,
    weights: Sequence[int] = (1, 2, 3),
    most_epochs: int = 3,
    seed: int = 42,
    identity: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """The rows of the mix, whole, as often as the mix takes them.

    A row at a cut comes once more if at least half of it was taken. The columns
    are those of ``docs``.
    """
    mixed = _mixed(docs, weights, most_epochs, seed, identity, text, source)
    copies = F.round(F.col("taken") / F.greatest(F.col("size"), F.lit(1))).cast("int")
    repeated = mixed.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), copies)))
    return repeated.select(*unpacked(docs.columns, []))
