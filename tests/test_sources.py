import os

import pytest
from pyspark.sql import functions as F

from dimspark.functions import safe_timestamp
from dimspark.sources import (
    SOURCE_SCHEMAS,
    layer_path,
    read_seed,
    read_source,
    read_table,
    register_views,
    shared,
    shared_folder,
    source_schema,
    store,
    write_table,
)


def test_schemas_are_valid(spark):
    assert len(SOURCE_SCHEMAS) == 23
    assert all(source_schema(name).fields for name in SOURCE_SCHEMAS)


def test_seed_with_byte_order_mark(spark, tmp_path, ts):
    path = tmp_path / "seed.csv"
    path.write_text("﻿ColorID,ColorName,ValidFrom\n1,Azure,2013-01-01 00:00:00.0000000\n", encoding="utf-8")
    seed = read_seed(spark, str(path), "ColorID int, ColorName string, ValidFrom string")
    row = seed.withColumn("ValidFrom", safe_timestamp(seed["ValidFrom"])).first()
    assert seed.columns[0] == "ColorID" and tuple(row) == (1, "Azure", ts("2013-01-01"))


def test_read_source_keeps_types_and_prunes(spark, tmp_path):
    df = spark.createDataFrame([(1, "Box", "x")], "packagetypeid int, packagetypename string, extra string")
    df.write.parquet(str(tmp_path / "PackageTypes.parquet"))
    found = read_source(spark, str(tmp_path), "PackageTypes")
    assert found.columns == ["packagetypeid", "packagetypename"]
    assert found.schema["packagetypeid"].dataType.simpleString() == "int"


def test_read_source_from_text_and_catalog(spark, tmp_path):
    (tmp_path / "PackageTypes.csv").write_text("packagetypeid,packagetypename\n1,Box\n")
    found = read_source(spark, str(tmp_path), "PackageTypes", "csv")
    assert [tuple(r) for r in found.collect()] == [(1, "Box")] and found.schema == source_schema("PackageTypes")
    (tmp_path / "PackageTypes.json").write_text('{"packagetypeid": 1, "packagetypename": "Box"}\n')
    assert [tuple(r) for r in read_source(spark, str(tmp_path), "PackageTypes", "json").collect()] == [(1, "Box")]


def test_missing_column_fails(spark, tmp_path):
    spark.range(1).write.parquet(str(tmp_path / "PackageTypes.parquet"))
    with pytest.raises(Exception, match="packagetypeid"):
        read_source(spark, str(tmp_path), "PackageTypes")


def test_tables_and_views(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, v string")
    path = str(tmp_path / "t")
    write_table(df, path, ["id"])
    written = write_table(df, path, ["id"])
    assert written.columns == ["id", "v"] and rows(written) == [(1, "a"), (2, "b")]
    assert read_table(spark, path).count() == 2
    register_views(spark, {"t_view": written})
    assert spark.sql("SELECT v FROM t_view WHERE id = 2 LIMIT 5").first()[0] == "b"


def test_layer_path():
    cfg = {"root": "/data/", "default": "main", "staging": " stage ", "facts": "  "}
    assert layer_path(cfg, "staging", "t") == "/data/stage/t"
    assert layer_path(cfg, "facts", "t") == "/data/main/t"
    assert layer_path(cfg, "dimensions", "t") == "/data/main/t"


def test_stored_table_has_no_lineage(spark):
    stored = store(spark.range(10).withColumnRenamed("id", "n"))
    assert sorted(r["n"] for r in stored.collect()) == list(range(10))
    assert all(shared_folder(spark).removeprefix("file:") in f for f in stored.inputFiles())


def test_folder_setting_is_required_on_a_cluster(spark):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf(dict):
        def get(self, key, default=None):
            return super().get(key, default)

    class Session:
        sparkContext = Context()
        conf = Conf()

    with pytest.raises(ValueError, match=shared.SETTING):
        shared_folder(Session())
    Session.conf[shared.SETTING] = "/shared/folder/"
    assert shared_folder(Session()) == "/shared/folder"
    assert os.path.isdir(shared_folder(spark).removeprefix("file:"))


def _shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [found.apply(i).getName() for i in range(found.size())]
    return {name for name in names if name.startswith("shuffle_")}


@pytest.mark.parametrize("how", ["store", "write_table"])
def test_a_written_table_leaves_no_shuffle_files(spark, tmp_path, how):
    import time

    from dimspark.sources.shared import FREED

    setting, before = spark.conf.get(FREED, None), _shuffle_files(spark)
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    table = store(df) if how == "store" else write_table(df, f"{tmp_path}/t")
    until = time.time() + 10
    while (left := _shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.1)  # they are deleted beside the next work
    assert not left and spark.conf.get(FREED, None) == setting
    assert sorted(r["count"] for r in table.collect()) == [142] * 1 + [143] * 6
    # What was written can still be made again from the same DataFrame.
    assert df.count() == len(df.collect()) == 7


def test_the_setting_holds_until_the_last_thread_is_done(spark):
    from dimspark.sources.shared import FREED, freed_shuffles

    setting, first, second = spark.conf.get(FREED, None), freed_shuffles(spark), freed_shuffles(spark)
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(FREED) == "true"
    second.__exit__(None, None, None)
    assert spark.conf.get(FREED, None) == setting
