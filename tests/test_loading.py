import pytest
from pyspark.sql import functions as F

from dimspark.functions import END_OF_TIME
from dimspark.operators import (
    cutoff_window,
    incremental_filter,
    incremental_scd2,
    merge_table,
    merge_upsert,
    null_violations,
    orphan_keys,
    update_cutoff,
    watermark,
    with_lineage,
)
from dimspark.functions import ts_literal
from dimspark.sources import read_table, store, write_table

VERSIONS = "id bigint, name string, valid_from timestamp_ntz"
COLUMNS = ("key", "id", "name", "valid_from", "valid_to")


@pytest.fixture
def load(spark, ts):
    def run(target, versions, mode="append_only"):
        df = spark.createDataFrame(versions, VERSIONS)
        return store(incremental_scd2(target, df, "id", "key", mode=mode))

    return run


def test_two_loads_append(ts, rows, load):
    end = ts(END_OF_TIME)
    first = load(None, [(1, "a", ts(0)), (2, "b", ts(5)), (3, "n", None)])
    assert rows(first, *COLUMNS) == sorted(
        [(1, 1, "a", ts(0), end), (2, 2, "b", ts(5), end), (3, 3, "n", None, end)], key=repr
    )
    # A change of id 1, its next change, a new id, a late version of id 2 and one without a start.
    source = [(1, "a", ts(0)), (2, "b", ts(5)), (1, "a2", ts(8)), (1, "a3", ts(9)), (4, "d", ts(8)), (2, "late", ts(3)), (3, "n", None)]
    second = load(first, source)
    added = [(4, 1, "a2", ts(8), ts(9)), (5, 1, "a3", ts(9), end), (6, 4, "d", ts(8), end)]
    assert rows(second, *COLUMNS) == sorted(rows(first, *COLUMNS) + added, key=repr)
    # The same source again adds nothing.
    assert rows(load(second, source), *COLUMNS) == rows(second, *COLUMNS)


def test_previous_version_can_be_closed(ts, rows, load):
    end = ts(END_OF_TIME)
    first = load(None, [(1, "a", ts(0)), (2, "b", ts(5))])
    second = load(first, [(1, "a2", ts(8)), (1, "a3", ts(9))], "close_previous")
    assert rows(second, *COLUMNS) == sorted(
        [(1, 1, "a", ts(0), ts(8)), (2, 2, "b", ts(5), end), (3, 1, "a2", ts(8), ts(9)), (4, 1, "a3", ts(9), end)], key=repr
    )


def test_empty_target_uses_the_floors(spark, ts, rows, load):
    empty = load(None, [])
    assert empty.count() == 0
    assert rows(load(empty, [(1, "a", ts(0))]), "key", "id") == [(1, 1)]
    assert watermark(empty, "valid_from", ts_literal("1900-01-01")).first()[0] == ts("1900-01-01")


def test_incremental_filter_is_strict(spark, ts, rows):
    df = spark.createDataFrame([(1, "a", ts(1)), (2, "b", ts(2)), (3, "c", None)], VERSIONS)
    target = spark.createDataFrame([(1, "x", ts(1))], VERSIONS)
    assert rows(incremental_filter(df, target, "valid_from"), "id") == [(2,)]


def test_merge(spark, rows):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "id bigint, v string")
    updates = spark.createDataFrame([("B", 2), ("c", 3), ("m", None)], "v string, id bigint")
    expected = sorted([(1, "a"), (2, "B"), (3, "c"), (None, "n"), (None, "m")], key=repr)
    assert rows(merge_upsert(target, updates, ["id"])) == expected


def test_cutoff_window(spark, ts, rows):
    df = spark.createDataFrame([(n, "", ts(n)) for n in range(5)], VERSIONS)

    def ids(*bounds):
        return [r[0] for r in rows(cutoff_window(df, "valid_from", *bounds), "id")]

    assert ids("2020-01-02", "2020-01-04") == [2, 3]
    assert ids("", "2020-01-02") == [0, 1]
    assert ids("2020-01-03", None) == [3, 4]
    assert ids() == [0, 1, 2, 3, 4]


def test_stored_cutoff(spark, ts, rows):
    schema = "table_name string, cutoff_time timestamp_ntz"
    state = spark.createDataFrame([("a", ts(1)), ("b", ts(1))], schema)
    reached = spark.createDataFrame([("b", ts(2)), ("c", ts(3))], schema)
    assert rows(update_cutoff(state, reached)) == sorted([("a", ts(1)), ("b", ts(2)), ("c", ts(3))], key=repr)


def test_run_id(spark):
    assert with_lineage(spark.range(2), 7).schema["lineage_key"].dataType.simpleString() == "bigint"
    assert {r["lineage_key"] for r in with_lineage(spark.range(2), 7).collect()} == {7}


def test_checks(spark, rows):
    fact = spark.createDataFrame([(0, "x"), (1, None), (2, "y"), (9, "z"), (9, "w")], "customer_key bigint, v string")
    dim = spark.createDataFrame([(1,), (2,)], "customer_key bigint")
    assert rows(orphan_keys(fact, dim, "customer_key")) == [(9, "w"), (9, "z")]
    assert rows(null_violations(fact, "v")) == [(1, None)]
    assert null_violations(fact, "customer_key").count() == 0


def test_append_only_target_is_looked_up_by_newest_start(spark, ts, load):
    from dimspark.operators import lookup_key

    target = load(load(None, [(1, "a", ts(0))]), [(1, "a", ts(0)), (1, "b", ts(10))])
    fact = spark.createDataFrame([(0, 1, ts(5)), (1, 1, ts(15))], "row int, id bigint, at timestamp_ntz")
    for strategy in ("auto", "union_window", "ranked"):
        found = lookup_key(fact, target, "id", "id", "at", "key", "found", strategy)
        assert {r["row"]: r["found"] for r in found.collect()} == {0: 1, 1: 2}
    assert target.where(F.col("valid_to") == ts_literal(END_OF_TIME)).count() == 2
