"""As-of lookup of dimension keys for fact rows.

A fact row gets the key of the version whose period ``(start, end]`` covers its
time, the newest if several do, and the unknown key if none does. Rows are never
dropped or multiplied.

Ways to find it, all with the same result:

``broadcast``     one join on the id with the period as a further condition; the
                  dimension is broadcast while its measured size allows and
                  shuffled beyond that, when adaptive execution splits busy ids.
                  For short histories without overlaps, which match at most once.
``union_window``  facts' distinct (id, time) pairs and versions are put into one
                  sorted order. For long histories, and for append-only loads,
                  whose open rows overlap.
``ranked``        the newest of all covering versions of the distinct (id, time)
                  pairs. For any periods.
``auto``          measures the dimension and takes the first that is right.
                  Overlaps that the newest version simply overrides, as after
                  append-only loads, are cut out of the dimension beforehand.

The first two are wishes: where the measured periods don't allow them, the lookup
goes on as ``auto`` does. Broadcasts of all lookups of a fact share one budget of
bytes. If any lookup needs the fact's moments, the fact is written once, so that
its plan is evaluated once and a moment is the same wherever it is used. If several
lookups can't be broadcast, they are resolved on the ids and moments of numbered rows,
and the fact itself is shuffled once, by the number; rows without any of their ids stay
where they are. For a large fact the keys found so far are written halfway and at the end,
which frees the shuffle files of the steps before.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimspark.functions.periods import covers_open_closed
from dimspark.functions.scalars import UNKNOWN_KEY, safe_int
from dimspark.operators.histories import (
    BROADCAST_BYTES,
    History,
    cut_at_successor,
    joined_versions,
    latest_versions,
    measure_once,
    newest_covering_version,
    setting,
)
from dimspark.operators.joins import hashable, scattered
from dimspark.sources.shared import remove_named, store, store_named

# A setting of a session, with its default: the bytes that the lookups of a fact beyond the broadcasts
# may leave in shuffle files together, and what a row of ids, a moment and a number takes there.
SHUFFLED_BYTES = ("dimspark.shuffledBytes", 1 << 30)
ROW_BYTES = 32

Strategy = Literal["auto", "broadcast", "union_window", "ranked"]

_ROW = "_fact_row"


@dataclass(frozen=True)
class Lookup:
    """Fill ``alias`` with ``dim[key]`` for ``fact[fact_id] = dim[dim_id]`` at ``fact[at]``."""

    dim: DataFrame
    fact_id: str
    dim_id: str
    key: str
    alias: str
    at: str = "last_modified_when"
    start: str = "valid_from"
    end: str = "valid_to"
    strategy: Strategy = "auto"

    @property
    def periods(self) -> tuple:
        """What identifies the measured periods: lookups may share them and differ in key and strategy."""
        return id(self.dim), self.dim_id, self.start, self.end


@dataclass(frozen=True)
class _Choice:
    """Versions to look up, the way to do it, and whether to broadcast them."""

    versions: DataFrame
    strategy: Strategy
    history: History
    small: bool = False


def lookup_key(
    fact: DataFrame,
    dim: DataFrame,
    fact_id: str,
    dim_id: str,
    at: str,
    key: str,
    alias: str,
    strategy: Strategy = "auto",
    start: str = "valid_from",
    end: str = "valid_to",
) -> DataFrame:
    """``fact`` with the key column ``alias`` added."""
    return lookup_keys(fact, [Lookup(dim, fact_id, dim_id, key, alias, at, start, end, strategy)])


def lookup_keys(fact: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """``fact`` with one key column per lookup. Each dimension is measured once."""
    histories = measure_once(
        {
            str(look.periods): (look.dim, _bigint(look.dim, look.dim_id), look.dim_id, look.start, look.end)
            for look in lookups
        }
    )
    chosen: dict[tuple, _Choice] = {}
    for look in lookups:
        of = (*look.periods, look.key, look.strategy)
        if of not in chosen:
            chosen[of] = _choose(look, histories[str(look.periods)])
    left = setting(fact.sparkSession, BROADCAST_BYTES)
    for of, choice in sorted(chosen.items(), key=lambda c: c[1].history.bytes):
        if choice.strategy == "broadcast" and choice.history.bytes <= left:
            left -= choice.history.bytes
            chosen[of] = replace(choice, small=True)
    columns = [*fact.columns, *[look.alias for look in lookups]]

    def choice_of(looks: list[Lookup]) -> _Choice:
        return chosen[*looks[0].periods, looks[0].key, looks[0].strategy]

    together = _sharing(lookups)
    large = [looks for looks in together if not choice_of(looks).small]
    moments = _Moments([looks for looks in together if choice_of(looks).strategy != "broadcast"])
    if sum(map(len, large)) > 1:
        # The wide fact would move once for each role. Instead its rows are numbered, the
        # roles are resolved on ids, moments and numbers alone, and the fact moves once.
        # Rows that have none of these ids don't move: they find nothing.
        fact = store(fact.withColumn(_ROW, F.monotonically_increasing_id()))
        roles = [look for looks in large for look in looks]
        findable = reduce(Column.__or__, [_bigint(fact, look.fact_id).isNotNull() for look in roles])
        keyed = narrow = fact.where(findable).select(_ROW, *dict.fromkeys(c for look in roles for c in (look.fact_id, look.at)))
        much = fact.count() * len(roles) * ROW_BYTES > setting(fact.sparkSession, SHUFFLED_BYTES)
        found, halfway = 0, None
        for looks in large:
            # The number alone scatters rows without an id, so that an id is left behind once its key is found.
            keyed = _add_keys(keyed, narrow, looks, choice_of(looks), moments, [_ROW])
            found += len(looks)
            if much and halfway is None and len(roles) / 2 <= found < len(roles):
                keyed, halfway = store_named(keyed)
        if much:
            keyed = store(keyed.select(_ROW, *[look.alias for look in roles]))
            if halfway:
                remove_named(fact.sparkSession, halfway)
        # Broadcasts come before the fact moves: their ids and moments stay behind.
        for looks in together:
            if choice_of(looks).small:
                fact = _add_keys(fact, fact, looks, choice_of(looks), moments, [_ROW])
        moved, left_out = fact.where(findable), fact.where(~findable)
        keyed = moved.join(keyed.select(_ROW, *[look.alias for look in roles]), _ROW)
        unknown = [F.lit(UNKNOWN_KEY).cast("bigint").alias(look.alias) for look in roles]
        return keyed.unionByName(left_out.select("*", *unknown)).select(*columns)
    if any(choice.strategy != "broadcast" for choice in chosen.values()):
        fact = store(fact)
    keyed = fact
    # Broadcasts come last: the fact moves with its ids, and what they find needn't move too.
    for looks in sorted(together, key=lambda looks: choice_of(looks).small):
        keyed = _add_keys(keyed, fact, looks, choice_of(looks), moments, hashable(fact))
    return keyed.select(*columns)


def _sharing(lookups: Sequence[Lookup]) -> list[list[Lookup]]:
    """Lookups by the versions and the key they take: roles of one dimension are resolved together."""
    groups: dict[tuple, list[Lookup]] = {}
    for look in lookups:
        groups.setdefault((*look.periods, look.key, look.strategy), []).append(look)
    return list(groups.values())


def _bigint(df: DataFrame, column: str) -> Column:
    return safe_int(F.col(column), df.schema[column].dataType)


def _versions(look: Lookup) -> DataFrame:
    """The dimension as (``_id``, ``_version``), without periods that cover nothing."""
    version = F.struct(F.col(look.start).alias("start"), F.col(look.end).alias("end"), F.col(look.key).alias("key"))
    covers_something = F.col("_id").isNotNull() & (F.col("_version.start") < F.col("_version.end"))
    return look.dim.select(_bigint(look.dim, look.dim_id).alias("_id"), version.alias("_version")).where(covers_something)


def _choose(look: Lookup, history: History) -> _Choice:
    """The versions to look up, and how."""
    versions = _versions(look)
    short = history.short(look.dim.sparkSession)
    joined: Strategy = "broadcast" if short and look.strategy != "union_window" else "union_window"
    if look.strategy == "ranked":
        return _Choice(versions, "ranked", history)
    if history.chained:
        return _Choice(versions, joined, history)
    # Ending each version where its successor starts leaves the newest in force
    # everywhere, as after an append-only load. It changes a result only where a
    # version, the last one too, has ended early and an older one still runs.
    cut = store(cut_at_successor(versions))
    per_id = cut.groupBy("_id").agg(
        F.max("_ends_early").alias("gap"),
        F.max("_outlives").alias("overlap"),
        (F.max("_last_end") < F.max("_reach")).alias("last_gap"),
    )
    if per_id.where("overlap AND (gap OR last_gap)").isEmpty():
        return _Choice(cut.select("_id", "_version"), joined, history)
    return _Choice(versions, "ranked", history)


class _Moments:
    """The distinct (id, time) pairs of a fact, written once for groups of lookups that take the same."""

    def __init__(self, groups: list[list[Lookup]]):
        taken = [self._of(looks) for looks in groups]
        self._repeated = {of for of in taken if taken.count(of) > 1}
        self._stored: dict[frozenset, DataFrame] = {}

    @staticmethod
    def _of(looks: list[Lookup]) -> frozenset:
        return frozenset((look.fact_id, look.at) for look in looks)

    def distinct(self, fact: DataFrame, looks: list[Lookup]) -> DataFrame:
        of = self._of(looks)
        if of not in self._stored:
            pairs = [fact.select(_bigint(fact, i).alias("_id"), F.col(at).alias("_at")).dropna() for i, at in sorted(of)]
            found = reduce(DataFrame.unionByName, pairs).distinct()
            if of not in self._repeated:
                return found
            self._stored[of] = store(found)
        return self._stored[of]


def _add_keys(
    keyed: DataFrame, fact: DataFrame, looks: list[Lookup], choice: _Choice, moments: _Moments, spread_by: list[str]
) -> DataFrame:
    """Add the keys of ``looks``, which take the same versions, to ``keyed``; moments come from ``fact``.

    A hash of ``spread_by`` scatters rows without an id.
    """
    if choice.strategy != "broadcast":
        resolved = _resolve(moments.distinct(fact, looks), choice)
        if len(looks) > 1:
            resolved = store(resolved)
    for look in looks:
        columns = keyed.columns
        fact_id, at = _bigint(keyed, look.fact_id), F.col(look.at)
        # A missing id matches nothing, yet all such rows would meet in one shuffle
        # partition. The first join key scatters them; the second keeps the match exact.
        spread = scattered(fact_id, T.LongType(), spread_by)
        same_id = (spread == F.col("_vid")) & (fact_id == F.col("_vid"))
        if choice.strategy == "broadcast":
            found = choice.versions.select(
                F.col("_id").alias("_vid"),
                F.col("_version.start").alias("_start"),
                F.col("_version.end").alias("_end"),
                F.col("_version.key").alias("_key"),
            )
            in_force = covers_open_closed(at, F.col("_start"), F.col("_end"))
            if choice.small:
                joined = keyed.join(F.broadcast(found), (fact_id == F.col("_vid")) & in_force, "left")
            else:
                joined = keyed.join(found, same_id & in_force, "left")
        else:
            moment = resolved.withColumnsRenamed({"_id": "_vid", "_at": "_vat"})
            joined = keyed.join(moment, same_id & (at == F.col("_vat")), "left")
        key = F.coalesce("_key", F.lit(UNKNOWN_KEY)).cast("bigint").alias(look.alias)
        keyed = joined.select(*columns, key)
    return keyed


def _resolve(moments: DataFrame, choice: _Choice) -> DataFrame:
    """(``_id``, ``_at``, ``_key``), one row per moment that has a version."""
    if choice.strategy == "union_window":
        latest = latest_versions(moments, choice.versions, inclusive=False)
        return latest.where(F.col("_at") <= F.col("_version.end")).select(
            "_id", "_at", F.col("_version.key").alias("_key")
        )
    if choice.history.short(moments.sparkSession):
        matches = joined_versions(moments, choice.versions, covers_open_closed)
        newest = matches.groupBy("_id", "_at").agg(F.max("_version").alias("_version"))
    else:
        newest = newest_covering_version(moments, choice.versions, covers_open_closed, inclusive=False)
    return newest.select("_id", "_at", F.col("_version.key").alias("_key"))
