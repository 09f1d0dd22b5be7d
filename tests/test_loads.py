import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from dimspark.functions import END_OF_TIME
from dimspark.operators import load_scd2, merge_upsert
from dimspark.sources import append_load, load_names, read_loads, remove_stored, scratch, shared, store
from dimspark.sources.tables import write_table

VERSIONS = "id bigint, name string, valid_from timestamp_ntz"


def files(path):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def test_loads_append_and_readers_see_whole_loads(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    assert read_loads(spark, path) is None
    first = append_load(spark.createDataFrame([(1, "a")], "id bigint, v string"), path)
    before = files(path)
    second = append_load(spark.createDataFrame([(2, "b")], "id bigint, v string"), path)
    assert rows(first) == [(1, "a")] and rows(second) == [(1, "a"), (2, "b")] == rows(read_loads(spark, path))
    assert set(before) < set(files(path))
    # A load without a pointer is no part of the table.
    spark.createDataFrame([(3, "c")], "id bigint, v string").write.parquet(f"{path}/load-lost")
    assert rows(read_loads(spark, path)) == [(1, "a"), (2, "b")]


def test_of_two_writers_one_fails(spark, rows, tmp_path, monkeypatch):
    import dimspark.sources.loads as module

    path, df = str(tmp_path / "t"), spark.createDataFrame([(1,)], "id bigint")
    append_load(df, path)
    append_load(df, path)
    seen = load_names(spark, path)
    monkeypatch.setattr(module, "load_names", lambda *_: seen[:1])
    with pytest.raises(RuntimeError, match="another load"):
        append_load(df, path)
    monkeypatch.undo()
    assert load_names(spark, path) == seen


def test_a_dimension_grows_by_new_versions_only(spark, ts, rows, tmp_path):
    path, end = str(tmp_path / "dim"), ts(END_OF_TIME)

    def load(data):
        return load_scd2(spark, path, spark.createDataFrame(data, VERSIONS), "id", "key")

    source = [(1, "a", ts(0)), (2, "b", ts(5))]
    assert rows(load(source), "key", "id", "valid_to") == [(1, 1, end), (2, 2, end)]
    source += [(1, "a2", ts(8)), (1, "a3", ts(9)), (2, "late", ts(3)), (3, "n", None)]
    expected = [(1, 1, end), (2, 2, end), (3, 1, ts(9)), (4, 1, end)]
    assert rows(load(source), "key", "id", "valid_to") == expected
    written = files(path)
    assert rows(load(source), "key", "id", "valid_to") == expected
    assert files(path) == written and len(load_names(spark, path)) == 2


def test_two_updates_of_one_key_are_refused(spark):
    target = spark.createDataFrame([(1, "a")], "id bigint, v string")
    updates = spark.createDataFrame([(1, "b"), (1, "c"), (None, "x"), (None, "y")], "id bigint, v string")
    with pytest.raises(ValueError, match="several updates"):
        merge_upsert(target, updates, ["id"])
    assert merge_upsert(target, updates.where("id IS NULL"), ["id"]).count() == 3


@pytest.fixture
def folder(tmp_path, monkeypatch):
    """An empty shared folder for one test."""
    monkeypatch.setattr(shared, "shared_folder", lambda spark: str(tmp_path / "shared"))
    return str(tmp_path / "shared")


def test_scratch_tables_are_removed(spark, folder):
    with scratch(spark):
        assert store(spark.range(3)).count() == 3 and files(folder)
    assert not files(folder)
    with pytest.raises(RuntimeError), scratch(spark):
        store(spark.range(3))
        raise RuntimeError
    assert not files(folder)
    with scratch(spark) as outer, scratch(spark) as inner:
        store(spark.range(3))
        with inner.suspended():
            store(spark.range(4))
        assert (len(inner.paths), len(outer.paths)) == (1, 1)
    assert not files(folder)
    store(spark.range(3))
    assert files(folder)
    remove_stored(spark)
    assert not files(folder)


@pytest.mark.parametrize("fails", [False, True])
def test_a_build_leaves_nothing_behind(spark, folder, tmp_path, fails):
    from dimspark.checks.bindings import Sources
    from dimspark.plans.warehouse import build_warehouse

    def write(name, df):
        if fails and name == "fct_order":
            raise RuntimeError("disk full")
        return write_table(df, f"{tmp_path}/dw/{name}")

    sources = Sources(spark, "/root/testdata/sf0.001")
    if fails:
        with pytest.raises(RuntimeError, match="disk full"):
            build_warehouse(sources, write)
    else:
        assert build_warehouse(sources, write)["fct_order"].where("customer_key > 0").count() > 0
    assert not files(folder)


def test_a_folder_is_always_required():
    unset = SimpleNamespace(conf={}, sparkContext=SimpleNamespace(getCheckpointDir=lambda: None))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.shared_folder(unset)


@pytest.mark.parametrize("key, value", [("spark.sql.session.timeZone", "America/New_York"), ("spark.sql.ansi.enabled", "false")])
def test_a_session_with_other_settings_is_refused(spark, key, value):
    from dimspark.plans.warehouse import build_warehouse

    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        with pytest.raises(ValueError, match=key):
            build_warehouse({}, lambda name, df: df)
    finally:
        spark.conf.set(key, before)


def test_a_decimal_product_that_does_not_fit_fails(spark):
    from dimspark.plans.staging import _net_and_tax

    def lines(quantity, price, rate):
        df = spark.range(1).select(F.lit(quantity).alias("quantity"), F.lit(price).alias("unitprice"), F.lit(rate).alias("taxrate"))
        return df.select(F.col("quantity").cast("bigint"), F.col("unitprice").cast("decimal(18,2)"), F.col("taxrate").cast("decimal(18,3)"))

    df = lines(3, "1.25", "6.125")
    assert [str(v) for v in df.select(*_net_and_tax(df)).first()] == ["3.750000000", "0.229687500", "3.979687500"]
    big = lines(10**17, "100.00", "6.125")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        big.select(*_net_and_tax(big)).collect()
    wide = df.withColumn("taxrate", F.col("taxrate").cast("decimal(38,3)"))
    with pytest.raises(ValueError, match="too long"):
        _net_and_tax(wide)
