"""Measuring version tables, and finding the versions that cover a moment.

A version table is passed as (``_id``, ``_version``) where ``_version`` is a
narrow struct that begins with ``start`` and ``end`` and tells versions apart;
moments are (``_id``, ``_at``). Which of the ways below is taken never changes a
result, only its cost.
"""

from __future__ import annotations

import weakref
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dimspark.operators.ordering import POSITION, SLICE, across_slices, last_of_key, order_rows
from dimspark.operators.versions import with_next
from dimspark.sources.shared import freed_shuffles

# Settings of a session, with their defaults. The bytes that the broadcast tables of
# one fact may take together, and the longest history that is joined on its id: a
# hash or merge join compares a moment with every version of that id, and up to this
# length that is cheaper than sorting moments and versions.
BROADCAST_BYTES = ("dimspark.broadcastBytes", 128 << 20)
LONGEST_JOINED = ("dimspark.longestJoined", 256)

# What a version of a key lookup takes in a broadcast hash table: an id, two times
# and a key of eight bytes each, and as much again for the table.
VERSION_BYTES = 64

Covers = Callable[[Column, Column, Column], Column]


def setting(spark: SparkSession, named: tuple[str, int]) -> int:
    return int(spark.conf.get(named[0], str(named[1])))


@dataclass(frozen=True)
class History:
    """What a version table looks like, measured over all of its rows."""

    rows: int
    longest: int
    chained: bool

    @property
    def bytes(self) -> int:
        return self.rows * VERSION_BYTES

    def short(self, spark: SparkSession) -> bool:
        return self.longest <= setting(spark, LONGEST_JOINED)


def periods(df: DataFrame, key: str | Column, start: str, end: str) -> DataFrame:
    """The columns that ``measure`` takes."""
    key = F.col(key) if isinstance(key, str) else key
    return df.select(key.alias("_id"), F.col(start).alias("_start"), F.col(end).alias("_end"))


def measure(tables: Mapping[str, DataFrame]) -> dict[str, History]:
    """Measure (``_id``, ``_start``, ``_end``) tables in a single job.

    A history is *chained* if each version ends where the next begins. That
    holds exactly when no period is reversed and the ends, without the greatest,
    are the same collection as the starts without the least; both collections
    are compared by sums of hashes. Chained periods cannot overlap.
    """

    def per_id(df: DataFrame) -> DataFrame:
        def digest(c) -> Column:
            return F.pmod(F.xxhash64(c), F.lit(1 << 31))

        usable = df.where("_id IS NOT NULL AND _start IS NOT NULL")
        return usable.groupBy("_id").agg(
            F.count("*").alias("n"),
            F.coalesce(F.max(F.col("_end").isNull() | (F.col("_end") < F.col("_start"))), F.lit(True)).alias("reversed"),
            (F.sum(digest("_start")) - digest(F.min("_start"))).alias("starts"),
            (F.sum(digest("_end")) - digest(F.max("_end"))).alias("ends"),
        )

    def summary(name: str, df: DataFrame) -> DataFrame:
        return per_id(df).agg(
            F.lit(name).alias("name"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.coalesce(F.max("n"), F.lit(0)).alias("longest"),
            F.coalesce(F.min(~F.col("reversed") & F.col("starts").eqNullSafe(F.col("ends"))), F.lit(True)).alias("chained"),
        )

    if not tables:
        return {}
    summaries = reduce(DataFrame.unionByName, [summary(n, df) for n, df in tables.items()])
    with freed_shuffles(summaries.sparkSession):
        found = summaries.collect()
    return {r["name"]: History(r["rows"], r["longest"], r["chained"]) for r in found}


_known: weakref.WeakKeyDictionary[DataFrame, dict[tuple, History]] = weakref.WeakKeyDictionary()


def measure_once(wanted: Mapping[str, tuple[DataFrame, Column, str, str, str]]) -> dict[str, History]:
    """Measure dimensions, each DataFrame object once however many facts look it up.

    ``wanted``: by name, the DataFrame, its id, and the names of id, start and end.
    """
    missing = {}
    for name, (df, key, *columns) in wanted.items():
        if tuple(columns) not in _known.setdefault(df, {}):
            missing[name] = periods(df, key, *columns[1:])
    for name, history in measure(missing).items():
        df, _, *columns = wanted[name]
        _known[df][tuple(columns)] = history
    return {name: _known[df][tuple(columns)] for name, (df, _, *columns) in wanted.items()}


def latest_versions(moments: DataFrame, versions: DataFrame, inclusive: bool) -> DataFrame:
    """Each moment with the last version that started before it (or at it, if ``inclusive``).

    Moments and versions are put into one order by id and time, where the answer
    is the last version seen while a slice is written. A slice that begins inside
    an id takes the last version of the slices before it. Moments without such a
    version are left out.
    """
    moment_side, version_side = (1, 0) if inclusive else (0, 1)
    struct_type = versions.schema["_version"].dataType
    points = moments.select(
        "_id", "_at", F.lit(moment_side).alias("_side"), F.lit(None).cast(struct_type).alias("_version")
    ).unionByName(
        versions.where("_id IS NOT NULL AND _version.start IS NOT NULL").select(
            "_id", F.col("_version.start").alias("_at"), F.lit(version_side).alias("_side"), "_version"
        )
    )
    order = [F.col(c) for c in ("_id", "_at", "_side", "_version")]
    rows = order_rows(points, order, last_of_key("_id", points.schema["_version"]))

    is_version = F.col("_side") == version_side
    last_in_slice = F.max_by(F.struct("_id", "_version"), F.when(is_version, F.col(POSITION)))
    earlier = across_slices().rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        rows.groupBy(SLICE)
        .agg(last_in_slice.alias("_last"))
        .select(SLICE, F.last("_last", ignorenulls=True).over(earlier).alias("_carried"))
    )
    of_earlier_slices = F.when(F.col("_carried._id") == F.col("_id"), F.col("_carried._version"))
    return (
        rows.where(~is_version)
        .join(F.broadcast(carried), SLICE)
        .withColumn("_found", F.coalesce("_seen", of_earlier_slices))
        .where(F.col("_found").isNotNull())
        .select("_id", "_at", F.col("_found").alias("_version"))
    )


def _covers(covers: Covers, version: str) -> Column:
    return covers(F.col("_at"), F.col(f"{version}.start"), F.col(f"{version}.end"))


def joined_versions(moments: DataFrame, versions: DataFrame, covers: Covers) -> DataFrame:
    """Every (moment, covering version) by a plain join on the id; for short histories."""
    same_id = F.col("_id") == F.col("_vid")
    return moments.join(versions.withColumnRenamed("_id", "_vid"), same_id & _covers(covers, "_version")).select(
        "_id", "_at", "_version"
    )


def _with_successor(versions: DataFrame) -> DataFrame:
    """Versions with ``_next``, the start of the next version of the same id."""
    flat = versions.where("_id IS NOT NULL AND _version.start IS NOT NULL").select(
        "_id", F.col("_version.start").alias("_start"), "_version"
    )
    return with_next(flat, "_id", "_start", ["_version"])


def cut_at_successor(versions: DataFrame) -> DataFrame:
    """Versions that end no later than the next one starts.

    ``_outlives`` and ``_ends_early`` tell whether a version ended after or before
    that, ``_reach`` is its own end, and ``_last_end`` that of the id's last version.
    Ends must not be NULL.
    """
    end, successor = F.col("_version.end"), F.col("_next.start")
    return _with_successor(versions).select(
        "_id",
        F.col("_version").withField("end", F.least(end, successor)).alias("_version"),
        F.coalesce(end > successor, F.lit(False)).alias("_outlives"),
        F.coalesce(end < successor, F.lit(False)).alias("_ends_early"),
        end.alias("_reach"),
        F.when(F.col("_next").isNull(), end).alias("_last_end"),
    )


def _outliving(versions: DataFrame) -> DataFrame:
    """Versions that end after their successor starts; a chained history has none."""
    outlives = F.col("_version.end").isNull() | (F.col("_version.end") > F.col("_next.start"))
    return _with_successor(versions).where(F.col("_next").isNotNull() & outlives).select(
        F.col("_id").alias("_oid"), F.col("_version").alias("_older")
    )


def _micros(time: Column) -> Column:
    """Microseconds of an unzoned time; only differences and order matter here."""
    return F.unix_micros(time.cast("timestamp"))


def _older_versions(latest: DataFrame, versions: DataFrame, covers: Covers) -> DataFrame:
    """Covering versions that are older than the latest one of their moment.

    To cover a moment in spite of a later start elsewhere, a version must outlive
    its successor, so only such versions are compared. They are grouped by length:
    one of up to 2**n microseconds lies in one or two cells of that width, and
    meets only the moments in those cells, of which it covers a fair share. The
    work thus follows the number of results; an id with many moments and many
    versions is spread over its cells.
    """
    outliving = _outliving(versions).withColumn("_from", _micros(F.col("_older.start")))
    until = F.coalesce(_micros(F.col("_older.end")), F.lit((1 << 62) - 1))
    outliving = outliving.withColumn("_until", F.greatest(until, F.col("_from")))
    length = F.greatest(F.col("_until") - F.col("_from"), F.lit(1)).cast("double")
    outliving = outliving.withColumn("_width", F.least(F.ceil(F.log2(length)).cast("int") + 1, F.lit(62)))

    def cell(micros: Column) -> Column:
        return F.call_function("shiftright", micros, F.col("_width"))

    outliving = outliving.withColumn("_cell", F.explode(F.array_distinct(F.array(cell(F.col("_from")), cell(F.col("_until"))))))
    # There are 62 widths at most. A moment is looked up once for each that occurs.
    widths = [r["_width"] for r in outliving.select("_width").distinct().collect()]
    if not widths:
        return latest.select("_id", "_at", "_version").where(F.lit(False))
    placed = latest.withColumn("_width", F.explode(F.array(*map(F.lit, sorted(widths)))))
    placed = placed.withColumn("_cell", cell(_micros(F.col("_at")))).withColumnRenamed("_width", "_mwidth").withColumnRenamed("_cell", "_mcell")
    met = (F.col("_id") == F.col("_oid")) & (F.col("_mwidth") == F.col("_width")) & (F.col("_mcell") == F.col("_cell"))
    condition = met & (F.col("_older") < F.col("_version")) & _covers(covers, "_older")
    return placed.join(outliving, condition).select("_id", "_at", F.col("_older").alias("_version"))


def covering_versions(moments: DataFrame, versions: DataFrame, covers: Covers, inclusive: bool) -> DataFrame:
    """Every (moment, covering version) for long histories."""
    latest = latest_versions(moments, versions, inclusive)
    older = _older_versions(latest, versions, covers)
    return latest.where(_covers(covers, "_version")).unionByName(older)


def newest_covering_version(moments: DataFrame, versions: DataFrame, covers: Covers, inclusive: bool) -> DataFrame:
    """The covering version with the latest start of each moment that has one; for long histories.

    Older versions are searched only for moments whose latest version has ended.
    """
    latest = latest_versions(moments, versions, inclusive)
    older = _older_versions(latest.where(~_covers(covers, "_version")), versions, covers)
    newest_older = older.groupBy("_id", "_at").agg(F.max("_version").alias("_version"))
    return latest.where(_covers(covers, "_version")).unionByName(newest_older)
