"""Rules counted while a table is written, and the log of a run."""

import pytest

from dimspark.operators import Rules, checked_write
from dimspark.sources import read_loads
from dimspark.sources.tables import read_table, write_table

FACT = "city_key bigint, item_key int, day date, n int, tags map<string,string>"


def write(spark, df, rules, path):
    return checked_write("fct", df, rules, lambda name, out: write_table(out, f"{path}/{name}"))


def test_nulls_and_orphans_are_counted_and_no_row_is_lost_or_multiplied(spark, rows, tmp_path):
    data = [(1, 1, None, 5, None), (0, 9, None, None, {"a": "b"}), (None, 1, None, 1, None), (7, 1, None, 2, None), (7, 2, None, 2, None)]
    cities = spark.createDataFrame([(1,), (1,), (2,), (None,)], "city_key bigint")  # a repeated key
    items = spark.createDataFrame([(1,), (2,)], "key bigint")
    rules = Rules(["day", "n", "city_key"], {"city_key": (cities, "city_key"), "item_key": (items, "key")})
    table, report = write(spark, spark.createDataFrame(data, FACT), rules, tmp_path)
    assert rows(table) == sorted(data, key=repr) and table.columns == ["city_key", "item_key", "day", "n", "tags"]
    assert report == [
        ("fct", "day", "not_null", 5, 5),
        ("fct", "n", "not_null", 1, 5),
        ("fct", "city_key", "not_null", 1, 5),
        ("fct", "city_key", "known", 2, 5),
        ("fct", "item_key", "known", 1, 5),
    ]


def test_an_empty_table_breaks_no_rule(spark, tmp_path):
    cities = spark.createDataFrame([], "city_key bigint")
    table, report = write(spark, spark.createDataFrame([], FACT), Rules(["n"], {"city_key": (cities, "city_key")}), tmp_path)
    assert table.count() == 0 and report == [("fct", "n", "not_null", 0, 0), ("fct", "city_key", "known", 0, 0)]


def test_many_rows_over_many_tasks(spark, tmp_path):
    fact = spark.range(100_000, numPartitions=16).selectExpr("id % 1000 AS city_key", "IF(id % 7 = 0, NULL, id) AS n")
    known = spark.range(900).selectExpr("id AS city_key")
    table, report = write(spark, fact, Rules(["n"], {"city_key": (known, "city_key")}), tmp_path)
    assert [r[3:] for r in report] == [(14_286, 100_000), (10_000, 100_000)] and table.count() == 100_000


def test_the_counts_are_taken_by_the_write_alone(spark, tmp_path):
    plans = []

    def noted(name, df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write_table(df, f"{tmp_path}/{name}")

    fact = spark.range(10).selectExpr("id AS city_key")
    known = spark.range(9).selectExpr("id AS city_key")
    _, report = checked_write("fct", fact, Rules([], {"city_key": (known, "city_key")}), noted)
    assert report[0][3] == 1 and len(plans) == 1 and plans[0].count("CollectMetrics") == 1


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    from dimspark.checks.bindings import Sources
    from dimspark.plans.warehouse import build_warehouse, logged, store_log

    folder, report, log = str(tmp_path_factory.mktemp("dw")), [], []
    src = Sources(spark, "/root/testdata/sf0.001")
    tables = build_warehouse(src, logged(lambda name, df: write_table(df, f"{folder}/{name}"), 7, log), report=report)
    return tables, report, store_log(spark, f"{folder}/runs", log), folder


def test_a_build_reports_all_rules_of_all_facts(built):
    tables, report, _, _ = built
    assert len({r[0] for r in report}) == 6 and all(r[4] == tables[r[0]].count() for r in report)
    assert all(failures == 0 for _, _, rule, failures, _ in report if rule == "known")
    assert sum(failures for _, column, rule, failures, _ in report if (column, rule) == ("picked_date_key", "not_null")) > 0


def test_a_build_is_logged_with_its_row_counts(spark, built):
    tables, _, runs, folder = built
    found = {r.model: r for r in runs.collect()}
    assert found.keys() == tables.keys() and len(found) == 13
    assert all(r.rows == tables[m].count() and r.lineage_key == 7 and r.started <= r.finished for m, r in found.items())
    assert read_loads(spark, f"{folder}/runs").count() == 13 and read_table(spark, f"{folder}/fct_order").count() == found["fct_order"].rows


@pytest.mark.parametrize("apart", [1, 10**12])
def test_a_checked_fact_stays_where_it_is_for_large_dense_dimensions(spark, tmp_path, apart):
    """Keys far apart, which bitmaps don't suit, are joined; both count the same."""
    plans = []

    def noted(name, df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write_table(df, f"{tmp_path}/{name}")

    key, before = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(key, "-1")
    try:
        fact = spark.range(-50, 100_000).selectExpr(f"IF(id % 10 = 9, NULL, (id % 70000) * {apart}) AS city_key", "id AS n")
        cities = spark.range(-10, 60_000).selectExpr(f"id * {apart} AS city_key").union(spark.sql("SELECT CAST(NULL AS bigint)"))
        table, report = checked_write("fct", fact, Rules([], {"city_key": (cities.union(cities), "city_key")}), noted)
    finally:
        spark.conf.set(key, before)
    unknown = sum(not (-10 <= k < 60_000) for i in range(-50, 100_000) if (k := i % 70_000 if i >= 0 else i) != 0 and not _tenth(i))
    assert report == [("fct", "city_key", "known", unknown, 100_050)] and table.count() == 100_050
    assert ("SortMergeJoin" in plans[0]) == (apart > 1)


def _tenth(i):
    """SQL's remainder has the sign of the number."""
    return i >= 0 and i % 10 == 9


def test_facts_of_a_build_are_written_one_by_one_and_leave_nothing_behind(spark, tmp_path):
    import os

    from dimspark.checks.bindings import Sources
    from dimspark.operators.histories import BROADCAST_BYTES
    from dimspark.plans.warehouse import build_warehouse
    from dimspark.sources import shared

    stored, left, writing = {}, [], []

    def exists(path):
        return os.path.exists(path.removeprefix("file://").removeprefix("file:"))

    def write(name, df):
        if name.startswith("fct_"):
            assert not writing
            writing.append(name)
            left.extend(path for paths in stored.values() for path in paths if exists(path))
            stored[name] = list(shared._open[-1].paths)
            assert all(map(exists, stored[name]))
        table = write_table(df, f"{tmp_path}/{name}")
        if name.startswith("fct_"):
            writing.remove(name)
        return table

    spark.conf.set(BROADCAST_BYTES[0], "0")
    try:
        build_warehouse(Sources(spark, "/root/testdata/sf0.001"), write)
    finally:
        spark.conf.unset(BROADCAST_BYTES[0])
    # What a fact keeps on its way is gone before the next is written.
    assert len(stored) == 6 and any(stored.values()) and not left
