import random

import pytest
from pyspark.sql import functions as F

from dimspark.functions import END_OF_TIME
from dimspark.operators import Lookup, histories, lookup, lookup_key, lookup_keys, version_dimension
from dimspark.operators.histories import measure, periods

DIM = "id bigint, key bigint, valid_from timestamp_ntz, valid_to timestamp_ntz"
FACT = "row bigint, id bigint, at timestamp_ntz"
STRATEGIES = ["auto", "broadcast", "union_window", "ranked"]


def look_up(fact, dim, strategy="auto"):
    found = lookup_key(fact, dim, "id", "id", "at", "key", "found", strategy)
    return {r["row"]: r["found"] for r in found.collect()}


def brute_force(fact, dim):
    """The newest covering version of each fact row, or 0."""
    out = {}
    for row, key, at in fact:
        covering = [
            (start, end, k)
            for i, k, start, end in dim
            if None not in (i, key, at, start, end) and i == key and start < at <= end
        ]
        out[row] = max(covering)[2] if covering else 0
    return out


@pytest.fixture(params=["plain", "shuffled", "long"])
def size(request, spark):
    """The same tests with the dimension broadcast, shuffled, or regarded as having long histories."""
    changed = {"shuffled": histories.BROADCAST_BYTES, "long": histories.LONGEST_JOINED}.get(request.param)
    if changed:
        spark.conf.set(changed[0], "0")
    yield request.param
    if changed:
        spark.conf.unset(changed[0])


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_edges(spark, ts, size, strategy):
    end = ts(END_OF_TIME)
    change = ts("2021-01-01")
    dim = spark.createDataFrame(
        [(1, 1, ts("2020-01-01"), change), (1, 2, change, end), (2, 3, change, change), (2, 4, change, end)], DIM
    )
    cases = {
        "inside the first period": (1, ts("2020-06-01"), 1),
        "at the first start": (1, ts("2020-01-01"), 0),
        "at the change": (1, change, 1),
        "just after the change": (1, ts("2021-01-01 00:00:00.000001"), 2),
        "before history": (1, ts("2019-01-01"), 0),
        "unknown id": (9, ts("2022-01-01"), 0),
        "no id": (None, ts("2022-01-01"), 0),
        "no time": (1, None, 0),
        "versions with the same start": (2, ts("2022-01-01"), 4),
    }
    fact = spark.createDataFrame([(n, i, at) for n, (i, at, _) in enumerate(cases.values())], FACT)
    found = look_up(fact, dim, strategy)
    assert {case: found[n] for n, case in enumerate(cases)} == {case: key for case, (_, _, key) in cases.items()}


@pytest.mark.parametrize("strategy", ["auto", "union_window", "ranked"])
def test_open_rows_that_overlap_take_the_newest(spark, ts, size, strategy):
    end = ts(END_OF_TIME)
    dim = spark.createDataFrame([(1, 1, ts("2020-01-01"), end), (1, 2, ts("2021-01-01"), end)], DIM)
    fact = spark.createDataFrame([(0, 1, ts("2020-06-01")), (1, 1, ts("2022-01-01"))], FACT)
    assert look_up(fact, dim, strategy) == {0: 1, 1: 2}


def facts_for(ts, rng, ids, count=900):
    return [
        (n, 3 if n % 3 == 0 else rng.choice([None, 99, *ids]), None if rng.random() < 0.02 else ts(rng.randrange(120)))
        for n in range(count)
    ]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_closed_dimension_with_a_busy_id(spark, ts, size, strategy):
    rng = random.Random(11)
    versions = [(3 if n % 3 == 0 else rng.randrange(10), ts(rng.randrange(100)), f"v{n}") for n in range(300)]
    df = spark.createDataFrame(versions, "id bigint, valid_from timestamp_ntz, name string")
    dim = version_dimension(df, "id", "key").cache()
    stored = [(r["id"], r["key"], r["valid_from"], r["valid_to"]) for r in dim.collect()]
    fact = facts_for(ts, rng, range(10))
    found = look_up(spark.createDataFrame(fact, FACT).repartition(4), dim, strategy)
    assert found == brute_force(fact, stored)


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_nested_periods_and_gaps(spark, ts, size, strategy):
    rng = random.Random(12)
    dim = []
    for n in range(200):
        start = rng.randrange(100)
        dim.append((rng.choice([None, 3, *range(6)]), n + 1, ts(start), ts(start + rng.choice([0, 1, 3, 10, 60]))))
    fact = facts_for(ts, rng, range(6))
    found = look_up(spark.createDataFrame(fact, FACT).repartition(4), spark.createDataFrame(dim, DIM), strategy)
    assert found == brute_force(fact, dim)


def test_text_ids_are_cast_on_both_sides(spark, ts):
    dim = spark.createDataFrame([("1", 5, ts(0), ts(10))], DIM.replace("id bigint", "id string"))
    fact = spark.createDataFrame([(0, "1", ts(5)), (1, "x", ts(5)), (2, " 1 ", ts(5))], FACT.replace("id bigint", "id string"))
    assert look_up(fact, dim) == {0: 5, 1: 0, 2: 5}


def test_equal_fact_rows_are_kept(spark, ts, size):
    dim = spark.createDataFrame([(1, 5, ts(0), ts(10))], DIM)
    fact = spark.createDataFrame([(0, 1, ts(5))] * 50 + [(0, None, ts(5))] * 50, FACT)
    found = lookup_key(fact, dim, "id", "id", "at", "key", "found")
    assert {tuple(r) for r in found.groupBy("found").count().collect()} == {(5, 50), (0, 50)}


def test_several_roles_of_one_dimension(spark, ts, size):
    dim = spark.createDataFrame([(1, 5, ts(0), ts(10)), (2, 6, ts(0), ts(10))], DIM)
    fact = spark.createDataFrame([(1, 2, ts(5)), (2, None, ts(5))], "a bigint, b bigint, at timestamp_ntz")
    found = lookup_keys(fact, [Lookup(dim, "a", "id", "key", "a_key", "at"), Lookup(dim, "b", "id", "key", "b_key", "at")])
    assert sorted(tuple(r) for r in found.select("a", "a_key", "b_key").collect()) == [(1, 5, 6), (2, 6, 0)]


def test_measure(spark, ts):
    def history(data):
        return measure({"x": periods(spark.createDataFrame(data, DIM), "id", "valid_from", "valid_to")})["x"]

    chained = history([(1, 1, ts(0), ts(5)), (1, 2, ts(5), ts(5)), (1, 3, ts(5), ts(9)), (2, 4, ts(1), ts(2))])
    assert (chained.rows, chained.longest, chained.chained) == (4, 3, True)
    assert not history([(1, 1, ts(0), ts(9)), (1, 2, ts(5), ts(9))]).chained
    assert not history([(1, 1, ts(0), ts(4)), (1, 2, ts(5), ts(9))]).chained
    assert not history([(1, 1, ts(5), ts(4))]).chained
    empty = history([])
    assert (empty.rows, empty.longest, empty.chained) == (0, 0, True)


def test_choice(spark, ts):
    def chosen(*data):
        dim = spark.createDataFrame(data, DIM)
        history = measure({"x": periods(dim, "id", "valid_from", "valid_to")})["x"]
        choice = lookup._choose(Lookup(dim, "id", "id", "key", "found"), history)
        return choice.strategy, sorted(r["_version"]["end"] for r in choice.versions.collect())

    # Chained; gaps only; overlaps that the newest overrides; an older version that reaches into a gap.
    assert chosen((1, 1, ts(0), ts(5)), (1, 2, ts(5), ts(9))) == ("broadcast", [ts(5), ts(9)])
    assert chosen((1, 1, ts(0), ts(4)), (1, 2, ts(5), ts(9))) == ("broadcast", [ts(4), ts(9)])
    assert chosen((1, 1, ts(0), ts(9)), (1, 2, ts(5), ts(9)), (2, 1, ts(0), ts(4)), (2, 2, ts(5), ts(6))) == (
        "broadcast",
        [ts(4), ts(5), ts(6), ts(9)],
    )
    assert chosen((1, 1, ts(0), ts(9)), (1, 2, ts(1), ts(2)), (1, 3, ts(4), ts(5))) == ("ranked", [ts(2), ts(5), ts(9)])


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_periods_with_gaps_and_without_end(spark, ts, size, strategy):
    dim = [(1, 1, ts(0), ts(4)), (1, 2, ts(6), ts(8)), (1, 3, ts(7), None), (1, 4, None, ts(9)), (1, 5, ts(7), ts(3))]
    fact = [(n, 1, ts(n)) for n in range(12)]
    found = look_up(spark.createDataFrame(fact, FACT), spark.createDataFrame(dim, DIM), strategy)
    assert found == brute_force(fact, dim)


def test_rows_without_id_are_scattered(spark, ts):
    """In a shuffled lookup the rows without an id must not share one partition."""
    spark.conf.set(histories.BROADCAST_BYTES[0], "0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        dim = spark.createDataFrame([(1, 5, ts(0), ts(10))], DIM)
        fact = spark.range(4000).select(F.col("id").alias("row"), F.lit(None).cast("bigint").alias("id"), F.lit(ts(5)).alias("at"))
        found = lookup_key(fact, dim, "id", "id", "at", "key", "found")
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset(histories.BROADCAST_BYTES[0])
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 4 and max(sizes) < 2000


def test_two_keys_and_strategies_of_one_dimension(spark, ts, size):
    schema = "id bigint, k1 bigint, k2 bigint, valid_from timestamp_ntz, valid_to timestamp_ntz"
    dim = spark.createDataFrame([(1, 10, 99, ts(0), ts(9)), (1, 11, 98, ts(2), ts(4))], schema)
    fact = spark.createDataFrame([(1, ts(3)), (1, ts(6))], "id bigint, at timestamp_ntz")
    looks = [Lookup(dim, "id", "id", k, f"{k}_{s}", "at", strategy=s) for s in STRATEGIES for k in ("k1", "k2")]
    found = lookup_keys(fact, looks).orderBy("at").collect()
    assert [[r[f"k1_{s}"] for s in STRATEGIES] for r in found] == [[11] * 4, [10] * 4]
    assert [[r[f"k2_{s}"] for s in STRATEGIES] for r in found] == [[98] * 4, [99] * 4]


def test_a_moment_that_differs_at_each_evaluation(spark, ts, size):
    dim = spark.createDataFrame([(1, 1, ts(0), ts(5)), (1, 2, ts(5), ts(END_OF_TIME))], DIM)
    fact = spark.range(20).select("id", F.current_timestamp().cast("timestamp_ntz").alias("at"), F.lit(1).cast("bigint").alias("item"))
    fact = fact.withColumn("at", F.col("at") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.rand()))
    for strategy in STRATEGIES:
        found = lookup_key(fact, dim, "item", "id", "at", "key", "found", strategy)
        assert {r["found"] for r in found.collect()} == {2}


def test_a_dimension_is_measured_once(spark, ts, monkeypatch):
    measured = []
    monkeypatch.setattr(histories, "measure", lambda tables: measured.extend(tables) or measure(tables))
    dim = spark.createDataFrame([(1, 5, ts(0), ts(10))], DIM)
    fact = spark.createDataFrame([(0, 1, ts(5))], FACT)
    for _ in range(3):
        look_up(fact, dim)
    assert len(measured) == 1


def test_one_id_with_a_third_of_moments_and_nested_versions(spark, ts):
    """Outliving versions are compared within cells of time, so a busy id's comparisons follow its results."""
    versions = [(1, n + 1, ts(n), ts(n + 1.5)) for n in range(800)] + [(2, 9000, ts(0), ts(9))]
    dim = spark.createDataFrame(versions, DIM).select("id", F.struct(F.col("valid_from").alias("start"), F.col("valid_to").alias("end"), "key").alias("v"))
    dim = dim.select(F.col("id").alias("_id"), F.col("v").alias("_version"))
    moments = spark.createDataFrame([(1, ts(n / 3)) for n in range(2400)], "_id bigint, _at timestamp_ntz")
    covers = lambda at, start, end: (start < at) & (at <= end)
    latest = histories.latest_versions(moments, dim, inclusive=False)
    older = histories._older_versions(latest, dim, covers)
    met = [c for c in older._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join Inner" in c]
    assert any("_cell" in c and "_width" in c for c in met)
    expected = sum(1 for n in range(2400) for v in (n // 3 - 1, n // 3 - 2) if v >= 0 and v < n / 3 <= v + 1.5 and n / 3 > v + 1)
    assert older.count() >= expected > 0


@pytest.mark.parametrize("kind", ["int", "smallint", "bigint", "decimal(12,2)", "decimal(30,0)", "string"])
def test_ids_of_any_type_are_scattered_where_they_are_missing(spark, kind):
    """A third of the rows has no id; no task of the shuffle join gets them all."""
    from dimspark.operators.joins import left_join

    left = spark.range(9000).selectExpr(f"CAST(IF(id % 3 = 0, NULL, id % 500) AS {kind}) AS key", "id AS row")
    right = spark.range(400).selectExpr(f"CAST(id AS {kind}) AS other", "id AS found")
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {key: spark.conf.get(key) for key in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    try:
        joined = left_join(left, right, "key", "other", ["row"])
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        found = joined.agg(F.count("*"), F.count("found"), F.count_if(F.col("key").isNull() & F.col("found").isNotNull())).first()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert tuple(found) == (9000, sum(i % 500 < 400 for i in range(9000) if i % 3), 0)
    assert len(sizes) == 8 and max(sizes) < 2 * 9000 / 8


def test_large_facts_keep_what_was_found_instead_of_shuffle_files(spark, rows, monkeypatch):
    """Keys are written halfway and at the end; the halfway table goes."""
    import os

    from dimspark.operators import lookup
    from dimspark.operators.histories import BROADCAST_BYTES
    from dimspark.sources.shared import collected

    fact = spark.range(300).selectExpr(
        "id", "id % 5 AS a", "IF(id % 3 = 0, NULL, id % 4) AS b", "id % 2 AS c", "timestamp_ntz'2000-01-01 00:00:00' + make_dt_interval(CAST(id % 50 AS INT)) AS at"
    )
    dims = [
        spark.range(n + 2).selectExpr(
            "id AS n", f"id * 10 + {n} AS key", "timestamp_ntz'2000-01-10 00:00:00' AS valid_from", "timestamp_ntz'9999-01-01 00:00:00' AS valid_to"
        )
        for n in range(2)
    ]
    lookups = [Lookup(dims[n], c, "n", "key", f"{c}_key", "at") for c, n in (("b", 1), ("c", 1), ("a", 0))]
    usual = rows(lookup_keys(fact, lookups))
    written, write = [], lookup.store_named

    def noted(df):
        table, path = write(df)
        written.append(path)
        return table, path

    monkeypatch.setattr(lookup, "store_named", noted)
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", BROADCAST_BYTES[0]: "0", lookup.SHUFFLED_BYTES[0]: "0"}
    before = {key: spark.conf.get(key, None) for key in changed}
    for key, value in changed.items():
        spark.conf.set(key, value)
    try:
        with collected() as stored:
            result = lookup_keys(fact, lookups)
            plan = result._jdf.queryExecution().executedPlan().toString()
            found = rows(result)
        stored.remove(spark)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert found == usual and any(r[-1] for r in found) and any(r[-2] for r in found)
    # The fact and what was found for it, each by the number.
    assert plan.count("hashpartitioning") == 2
    assert len(written) == 1 and not os.path.exists(written[0].removeprefix("file://"))
