import random

import pytest

from dimspark.operators import point_in_time_join
from dimspark.operators.histories import History

SHORT, LONG = History(10, 1, True), History(10, 10**6, True)
LEFT = "row bigint, category bigint, valid_from timestamp_ntz"
RIGHT = "id bigint, name string, p_from timestamp_ntz, p_to timestamp_ntz"


def join(left, right, how="left", history=None):
    return point_in_time_join(left, right, ("category", "id"), "valid_from", "p_from", "p_to", how, history)


@pytest.mark.parametrize("history", [None, SHORT, LONG])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_period_boundaries(spark, ts, rows, how, history):
    right = spark.createDataFrame(
        [(1, "A", ts("2020-01-01"), ts("2021-01-01")), (1, "B", ts("2021-01-01"), None)], RIGHT
    )
    cases = [("2020-01-01", "A"), ("2020-12-31", "A"), ("2021-01-01", "B"), ("2030-01-01", "B"), ("2019-12-31", None), (None, None)]
    left = spark.createDataFrame([(n, 1, ts(at)) for n, (at, _) in enumerate(cases)] + [(90, None, ts(0)), (91, 5, ts(0))], LEFT)
    expected = [(n, name) for n, (_, name) in enumerate(cases)] + [(90, None), (91, None)]
    if how == "inner":
        expected = [e for e in expected if e[1]]
    assert rows(join(left, right, how, history), "row", "name") == sorted(expected, key=repr)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_overlapping_periods_multiply_rows_in_the_same_way(spark, ts, rows, how):
    rng = random.Random(3)
    right = []
    for n in range(150):
        start = rng.randrange(100)
        right.append((rng.choice([None, 1, 1, 2, 3]), f"n{n}", ts(start), rng.choice([None, ts(start), ts(start + 2), ts(start + 30)])))
    left = [(n, rng.choice([None, 1, 2, 3, 4]), ts(rng.randrange(120))) for n in range(300)]
    expected = []
    for row, category, at in left:
        names = [name for i, name, f, t in right if i is not None and i == category and f <= at and (t is None or t > at)]
        expected += [(row, name) for name in names] or ([(row, None)] if how == "left" else [])
    left, right = spark.createDataFrame(left, LEFT).repartition(3), spark.createDataFrame(right, RIGHT).repartition(3)
    for history in (SHORT, LONG):
        assert rows(join(left, right, how, history), "row", "name") == sorted(expected, key=repr)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_repeated_versions_and_a_map_multiply_rows_in_the_same_way(spark, ts, rows, how):
    schema = "id bigint, name map<string, int>, p_from timestamp_ntz, p_to timestamp_ntz"
    right = [(1, {"n": 1}, ts(0), ts(5))] * 3 + [(1, {"n": 2}, ts(5), None)] * 2 + [(2, None, ts(0), None)]
    left = [(0, 1, ts(1)), (1, 1, ts(7)), (2, 2, ts(3)), (3, 9, ts(3)), (4, None, ts(3))]
    left, right = spark.createDataFrame(left, LEFT), spark.createDataFrame(right, schema)
    found = [rows(join(left, right, how, history).selectExpr("row", "name['n'] AS n"), "row", "n") for history in (SHORT, LONG)]
    expected = [(0, 1)] * 3 + [(1, 2)] * 2 + [(2, None)] + ([(3, None), (4, None)] if how == "left" else [])
    assert found == [sorted(expected, key=repr)] * 2
