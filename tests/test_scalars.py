import datetime as dt

import pytest
from pyspark.sql import functions as F

from dimspark.functions import (
    covers_closed_open,
    covers_open_closed,
    flag,
    last_modified,
    safe_date,
    safe_int,
    safe_timestamp,
    strict_date,
    ts_literal,
)


def values(spark, schema, data, make):
    df = spark.createDataFrame([(v,) for v in data], schema)
    return [r[0] for r in df.select(make(df["x"], df.schema["x"].dataType)).collect()]


@pytest.mark.parametrize(
    ("schema", "data", "expected"),
    [
        ("x string", ["12", " 12 ", "-7", "12.5", "1e3", "abc", "", None], [12, 12, -7, None, None, None, None, None]),
        ("x double", [2.5, -2.5, 2.4, float("nan"), None], [3, -3, 2, None, None]),
        ("x int", [5, None], [5, None]),
        ("x bigint", [2**40], [2**40]),
        ("x boolean", [True, False], [1, 0]),
    ],
)
def test_safe_int(spark, schema, data, expected):
    assert values(spark, schema, data, safe_int) == expected


def test_safe_int_rounds_decimals_away_from_zero(spark):
    df = spark.sql("SELECT explode(array(2.5BD, -2.5BD, 2.49BD)) AS x")
    assert [r[0] for r in df.select(safe_int(df["x"], df.schema["x"].dataType)).collect()] == [3, -3, 2]


def test_safe_timestamp(spark):
    data = {
        "9999-12-31 23:59:59.9999999": dt.datetime(9999, 12, 31, 23, 59, 59, 999999),
        "2013-01-01 00:00:00.0000000": dt.datetime(2013, 1, 1),
        "2013-01-01": dt.datetime(2013, 1, 1),
        "2013-01-01 12:00:00+02:00": dt.datetime(2013, 1, 1, 10),
        "2013": None,
        "2013-05": None,
        "12:30": None,
        "2013-02-30 00:00:00": None,
        "junk": None,
        None: None,
    }
    assert values(spark, "x string", list(data), lambda c, _: safe_timestamp(c)) == list(data.values())


def test_typed_values_are_not_parsed_again(spark):
    df = spark.sql("SELECT timestamp_ntz'2020-01-02 03:04:05.000006' AS a, timestamp'2020-01-02 03:04:05' AS b, date'2020-01-02' AS c")
    types = {f.name: f.dataType for f in df.schema}
    row = df.select(
        safe_timestamp(F.col("a"), types["a"]),
        safe_timestamp(F.col("b"), types["b"]),
        safe_timestamp(F.col("c"), types["c"]),
        safe_date(F.col("a"), types["a"]),
        safe_date(F.col("c"), types["c"]),
    ).first()
    assert tuple(row) == (
        dt.datetime(2020, 1, 2, 3, 4, 5, 6),
        dt.datetime(2020, 1, 2, 3, 4, 5),
        dt.datetime(2020, 1, 2),
        dt.date(2020, 1, 2),
        dt.date(2020, 1, 2),
    )


def test_safe_date(spark):
    data = {
        "2024-06-01": dt.date(2024, 6, 1),
        "2024-06-01 12:00:00": dt.date(2024, 6, 1),
        "2024-02-30": None,
        "2024-02": None,
        "2024": None,
        "pending": None,
        None: None,
    }
    assert values(spark, "x string", list(data), lambda c, _: safe_date(c)) == list(data.values())


def test_strict_date_fails_on_bad_text(spark):
    assert values(spark, "x string", ["2024-06-01"], lambda c, _: strict_date(c)) == [dt.date(2024, 6, 1)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(spark, "x string", ["junk"], lambda c, _: strict_date(c))


def test_last_modified_and_flag(spark, ts):
    df = spark.createDataFrame(
        [(ts(1), ts(2)), (ts(3), None), (None, ts(4)), (None, None)], "a timestamp_ntz, b timestamp_ntz"
    )
    assert [r[0] for r in df.select(last_modified(df["a"], df["b"])).collect()] == [ts(2), ts(3), ts(4), None]
    assert values(spark, "x boolean", [True, None], lambda c, _: flag(c)) == [1, None]


@pytest.mark.parametrize(
    ("at", "end", "closed_open", "open_closed"),
    [
        (0, 10, True, False),
        (5, 10, True, True),
        (10, 10, False, True),
        (11, 10, False, False),
        (-1, 10, False, False),
        (50, None, True, False),
        (None, 10, False, False),
    ],
)
def test_period_ends(spark, ts, at, end, closed_open, open_closed):
    df = spark.createDataFrame([(ts(at), ts(0), ts(end))], "t timestamp_ntz, f timestamp_ntz, e timestamp_ntz")
    found = df.select(
        F.coalesce(covers_closed_open(df["t"], df["f"], df["e"]), F.lit(False)),
        F.coalesce(covers_open_closed(df["t"], df["f"], df["e"]), F.lit(False)),
    ).first()
    assert tuple(found) == (closed_open, open_closed)


def test_end_literal_stays_without_zone(spark):
    df = spark.sql("SELECT timestamp_ntz'2020-01-01' AS x").select(F.coalesce("x", ts_literal("9999-12-31")).alias("x"))
    assert df.schema["x"].dataType.simpleString() == "timestamp_ntz"
