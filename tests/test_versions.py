import random

import pytest
from pyspark.sql import functions as F

from dimspark.functions import END_OF_TIME
from dimspark.operators import dense_key, scd1_latest, scd2_close, version_dimension

SCHEMA = "id bigint, valid_from timestamp_ntz, name string"


def nulls_first(*values):
    return tuple((v is not None, v) for v in values)


def expected_versions(data, ts):
    """Brute force: sort, close and number in plain Python."""
    ordered = sorted(data, key=lambda r: nulls_first(*r))
    out = []
    for n, (key, start, name) in enumerate(ordered):
        following = ordered[n + 1] if n + 1 < len(ordered) and ordered[n + 1][0] == key else None
        end = following[1] if following and following[1] is not None else ts(END_OF_TIME)
        out.append((n + 1, key, start, name, end))
    return sorted(out, key=repr)


@pytest.fixture
def skewed(ts):
    """A third of all rows has one id; some ids and starts are NULL; there are ties and exact copies."""
    rng = random.Random(5)
    data = []
    for n in range(3000):
        key = 7 if n % 3 == 0 else rng.choice([None, *range(200)])
        start = None if rng.random() < 0.02 else ts(rng.randrange(400))
        data.append((key, start, f"n{rng.randrange(50):02d}"))
    return data + data[:40]


def test_close_and_number_match_brute_force(spark, ts, rows, skewed):
    df = spark.createDataFrame(skewed, SCHEMA).repartition(5)
    found = version_dimension(df, "id", "key")
    assert rows(found, "key", "id", "valid_from", "name", "valid_to") == expected_versions(skewed, ts)
    assert rows(scd2_close(df, "id")) == sorted([r[1:] for r in expected_versions(skewed, ts)], key=repr)


@pytest.mark.parametrize("batch", [1, 7, 100])
def test_periods_span_arrow_batches(spark, ts, rows, skewed, batch):
    from dimspark.operators.histories import latest_versions

    data = skewed[:600] + skewed[-40:]
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(batch))
    try:
        df = spark.createDataFrame(data, SCHEMA).repartition(3)
        assert rows(scd2_close(df, "id")) == sorted([r[1:] for r in expected_versions(data, ts)], key=repr)
        versions = df.select(F.col("id").alias("_id"), F.struct(F.col("valid_from").alias("start"), "name").alias("_version"))
        moments = [(key, ts(at)) for key in (7, 3, 5, 250) for at in range(0, 400, 23)]
        asked = spark.createDataFrame(moments, "_id bigint, _at timestamp_ntz")
        found = latest_versions(asked, versions, True).select("_id", "_at", "_version.start", "_version.name")
        expected = []
        for key, at in moments:
            seen = [(start, name) for k, start, name in data if k == key and start is not None and start <= at]
            expected += [(key, at, *max(seen))] if seen else []
        assert rows(found) == sorted(expected, key=repr)
    finally:
        spark.conf.set(setting, before)


def test_numbers_match_row_number(spark, ts, rows, skewed):
    df = spark.createDataFrame(skewed, SCHEMA).repartition(5)
    found = dense_key(df, ["id", "valid_from", "name"], "key", above=100)
    expected = [(number + 100, *values) for number, *values, _ in expected_versions(skewed, ts)]
    assert rows(found) == sorted(expected, key=repr)


def test_a_busy_id_spans_slices(spark, ts):
    from dimspark.operators.ordering import SLICE, order_rows

    df = spark.range(4000).select(
        F.lit(1).alias("id"), F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("valid_from")
    )
    sizes = [r["count"] for r in order_rows(df, [F.col("id"), F.col("valid_from")]).groupBy(SLICE).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 2 * 4000 / 4


def test_exact_copies_span_slices(spark):
    from dimspark.operators.ordering import SLICE, order_rows

    df = spark.range(4000, numPartitions=8).select(F.lit(1).alias("id"))
    sizes = [r["count"] for r in order_rows(df, [F.col("id")]).groupBy(SLICE).count().collect()]
    assert len(sizes) > 1 and max(sizes) < 4000 * 0.6


def test_source_end_is_ignored(spark, ts, rows):
    df = spark.createDataFrame([(1, ts(0), ts(3)), (1, ts(10), ts(12))], "id bigint, valid_from timestamp_ntz, valid_to timestamp_ntz")
    assert rows(scd2_close(df, "id")) == sorted([(1, ts(0), ts(10)), (1, ts(10), ts(END_OF_TIME))], key=repr)


def test_periods_do_not_overlap(spark, skewed):
    df = spark.createDataFrame(skewed, SCHEMA).where("valid_from IS NOT NULL")
    closed = scd2_close(df, "id")
    assert closed.where("valid_from > valid_to").count() == 0
    a, b = closed.alias("a"), closed.where("valid_from < valid_to").alias("b")
    # A start strictly inside another period of the same id would be an overlap.
    inside = "a.id = b.id AND a.valid_from > b.valid_from AND a.valid_from < b.valid_to"
    assert a.join(b, F.expr(inside)).count() == 0


def test_empty_input(spark):
    empty = spark.createDataFrame([], SCHEMA)
    found = version_dimension(empty, "id", "key")
    assert found.columns == ["key", "id", "valid_from", "name", "valid_to"] and found.count() == 0


def test_key_type_and_columns(spark, ts):
    df = spark.createDataFrame([(1, ts(0), "a")], SCHEMA)
    found = dense_key(df, ["id"], "key")
    assert found.columns == ["key", *df.columns] and found.schema["key"].dataType.simpleString() == "bigint"


def test_latest_row(spark, ts, rows):
    data = [(1, ts(0), "a"), (1, ts(5), "b"), (1, ts(5), "c"), (2, None, "d"), (None, ts(1), "e")]
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(scd1_latest(df, "id", ["valid_from"])) == sorted([data[2], data[3], data[4]], key=repr)
