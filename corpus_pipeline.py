"""From raw documents to shards, in five stages.

Each stage takes the documents that the one before kept, and all but the last
return the columns of ``documents``. What a stage returns is written, and read
again by the next. ``run`` removes the tables that a stage has stored on its way when
its result is written; a caller of single stages has them removed when the next one
begins.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dimspark.llm.decontamination import decontaminate
from dimspark.llm.mixing import mixed_documents
from dimspark.llm.quality import judge
from dimspark.llm.queries import table
from dimspark.llm.sharding import shard
from dimspark.llm.simhash import one_of_each
from dimspark.sources.shared import Scratch, collected, scratch, store

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

_left_behind: list[Scratch] = []


def _tidy(stage: Stage) -> Stage:
    """Remove the tables of the stage before, whose result has been written when this one begins."""

    @functools.wraps(stage)
    def begin(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        while _left_behind:
            _left_behind.pop().remove(spark)
        with collected() as own:
            result = stage(spark, docs, sf_dir)
        _left_behind.append(own)
        return result

    return begin


@_tidy
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return judge(docs, table(spark, sf_dir, "labels")).where("kept").select(*docs.columns)


@_tidy
def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return one_of_each(docs)


@_tidy
def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by the benchmark."""
    judged = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return judged.where("NOT contaminated").select(*docs.columns)


@_tidy
def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix, whole, as often as the mix takes them."""
    return mixed_documents(docs)


@_tidy
def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and slot."""
    return shard(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", mixing_to_weights),
    ("sharding", sharding),
]

# The fingerprints, components and log-likelihood ratios of the first two stages are beyond SQL;
# tests/llm compares each stage with a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again.

    Tables that a stage stores on its way are removed when its result is written, but
    for those of the last stage, which the returned DataFrame reads. Runs share nothing.
    """
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        with scratch(spark) as own:
            kept = stage.__wrapped__(spark, docs, sf_dir)
            with own.suspended():
                docs = store(kept)
    return STAGES[-1][1].__wrapped__(spark, docs, sf_dir)
