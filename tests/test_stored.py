"""Tables that change in place: parts, spliced versions, keys that stay, loads by cutoff."""

import os
import random

import pytest
from pyspark.sql import functions as F

from dimspark.functions import ts_literal
from dimspark.operators import (
    load_by_cutoff,
    merge_table,
    overwrite_attributes,
    read_dimension,
    rebuild_dimension,
    splice_dimension,
    stable_dimension,
    stored_cutoff,
    version_dimension,
)
from dimspark.sources import append_load, load_names, read_loads, read_parts, replace_parts, whole, write_parts

VERSIONS = "id bigint, name string, valid_from timestamp_ntz"
PAIRS = "id bigint, v string"


def files(path):
    return {
        os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")
    }


def test_a_merge_touches_only_parts_that_hold_an_updated_key(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    write_parts(spark.createDataFrame([(i, f"v{i}") for i in range(400)], PAIRS), path, ["id"], 16)
    before = files(path)
    updates = spark.createDataFrame([(7, "new"), (1000, "added")], PAIRS)
    merged = merge_table(spark, path, updates, ["id"])
    assert rows(merged) == sorted([(i, "new" if i == 7 else f"v{i}") for i in range(400)] + [(1000, "added")], key=repr)
    after = files(path)
    touched = {os.path.basename(os.path.dirname(f)) for f in before.items() ^ after.items() for f in f[:1]}
    assert 1 <= len(touched) <= 2
    assert sum(before[f] == after.get(f) for f in before) >= len(before) - 2 * 4
    assert rows(merge_table(spark, path, updates, ["id"])) == rows(whole(read_parts(spark, path)))


def test_types_of_updates_and_their_order_of_columns_do_not_matter(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    write_parts(spark.createDataFrame([(i, "a") for i in range(50)], PAIRS), path, ["id"], 8)
    merged = merge_table(spark, path, spark.createDataFrame([("b", i) for i in range(50)], "v string, id int"), ["id"])
    assert merged.dtypes == [("id", "bigint"), ("v", "string")] and rows(merged) == sorted([(i, "b") for i in range(50)], key=repr)


def test_a_merge_makes_a_table_where_there_is_none(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    assert read_parts(spark, path) is None
    assert rows(merge_table(spark, path, spark.createDataFrame([(1, "a")], PAIRS), ["id"])) == [(1, "a")]
    empty = str(tmp_path / "empty")
    assert rows(write_parts(spark.createDataFrame([], PAIRS), empty, ["id"])) == []
    assert read_parts(spark, empty) is None
    assert rows(merge_table(spark, empty, spark.createDataFrame([(1, "a")], PAIRS), ["id"])) == [(1, "a")]


def test_two_updates_of_a_key_change_nothing_and_null_keys_are_added(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    write_parts(spark.createDataFrame([(1, "a"), (None, "n")], PAIRS), path, ["id"], 4)
    with pytest.raises(ValueError, match="several updates"):
        merge_table(spark, path, spark.createDataFrame([(1, "b"), (1, "c")], PAIRS), ["id"])
    assert rows(whole(read_parts(spark, path))) == [(1, "a"), (None, "n")]
    assert rows(merge_table(spark, path, spark.createDataFrame([(None, "m"), (1, "A")], PAIRS), ["id"])) == [(1, "A"), (None, "m"), (None, "n")]


def test_rows_without_a_key_lie_in_all_parts(spark, tmp_path):
    path = str(tmp_path / "t")
    write_parts(spark.createDataFrame([(None, f"v{i}") for i in range(400)], PAIRS), path, ["id"], 8)
    sizes = [r["count"] for r in read_parts(spark, path).groupBy("part_of_8").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 100


def test_a_part_without_rows_is_emptied(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    write_parts(spark.createDataFrame([(i, "a") for i in range(40)], PAIRS), path, ["id"], 4)
    table = read_parts(spark, path)
    replace_parts(spark, path, [0, 1], table.where("part_of_4 = 1"))
    assert {r[0] for r in read_parts(spark, path).select("part_of_4").distinct().collect()} == {1, 2, 3}


def sample(seed, ts, ids=12, n=150):
    rng = random.Random(seed)
    return [(rng.choice([*range(ids), None]), rng.choice(["a", "b", None]), rng.choice([ts(rng.randint(0, 30)), None])) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_spliced_versions_equal_a_rebuild(spark, ts, rows, tmp_path, seed):
    """Late, early, repeated and withdrawn versions, NULL ids and starts."""
    path, rng = str(tmp_path / "dim"), random.Random(seed)
    source = sample(seed, ts)
    columns = ["id", "name", "valid_from", "valid_to"]
    keys = {}
    for _ in range(4):
        some = spark.createDataFrame(source, VERSIONS)
        found = splice_dimension(spark, path, some, "id", "key", parts=8)
        assert rows(found, *columns) == rows(version_dimension(some, "id", "key"), *columns)
        numbers = [r["key"] for r in found.collect()]
        assert len(set(numbers)) == len(numbers) and min(numbers) >= 1
        known = {}
        for r in found.collect():
            known.setdefault((r.id, r.valid_from), set()).add(r.key)
        # A version keeps its key; of versions with equal id and start as many keep theirs as there were.
        assert all(keys[v] <= known[v] or known[v] <= keys[v] for v in keys.keys() & known.keys())
        keys = known
        source = [v for v in source if rng.random() < 0.9] + sample(rng.random(), ts, n=15)


def test_an_unchanged_source_writes_nothing_and_others_keep_their_files(spark, ts, rows, tmp_path):
    path = str(tmp_path / "dim")
    source = [(i, "a", ts(5)) for i in range(200)]
    splice_dimension(spark, path, spark.createDataFrame(source, VERSIONS), "id", "key", parts=16)
    before = files(path)
    splice_dimension(spark, path, spark.createDataFrame(source, VERSIONS), "id", "key")
    assert files(path) == before
    source += [(3, "late", ts(2)), (3, "later", ts(9))]
    found = splice_dimension(spark, path, spark.createDataFrame(source, VERSIONS), "id", "key")
    assert rows(found.where("id = 3"), "name", "valid_from", "valid_to")[:2] == [("a", ts(5), ts(9)), ("late", ts(2), ts(5))]
    changed = {os.path.dirname(f) for f in before if files(path).get(f) != before[f]}
    assert len(changed) == 1
    # The version that was there has its key still; the new ones continue from the greatest.
    assert [r[0] for r in sorted(found.where("id = 3").select("key", "name").collect(), key=lambda r: r[1])] == [4, 201, 202]


def test_a_rebuild_keeps_the_keys_that_loads_gave(spark, ts, rows, tmp_path):
    path = str(tmp_path / "dim")
    first, rest = [(2, "b", ts(4)), (1, "a", ts(6))], [(1, "early", ts(1)), (0, "new", ts(3))]
    rebuild_dimension(spark, path, spark.createDataFrame(first, VERSIONS), "id", "key")
    loaded = rows(splice_dimension(spark, path, spark.createDataFrame(first + rest, VERSIONS), "id", "key"))
    assert [(r[0], r[1]) for r in loaded] == [(1, 1), (2, 2), (3, 0), (4, 1)]
    assert rows(rebuild_dimension(spark, path, spark.createDataFrame(first + rest, VERSIONS), "id", "key")) == loaded
    # A version that comes back gets its old key.
    splice_dimension(spark, path, spark.createDataFrame(first, VERSIONS), "id", "key")
    assert rows(read_dimension(spark, path), "key") == [(1,), (2,)]
    assert rows(splice_dimension(spark, path, spark.createDataFrame(first + rest, VERSIONS), "id", "key")) == loaded


def test_equal_versions_keep_a_key_each(spark, ts):
    versions = spark.createDataFrame([(1, "x", ts(1))] * 300 + [(2, "y", ts(1))], VERSIONS)
    dimension, new = stable_dimension(versions, "id", "key")
    assert sorted(r["copy"] for r in new.where("id = 1").collect()) == list(range(300))
    again, added = stable_dimension(versions, "id", "key", known=new)
    assert added.count() == 0 and sorted(map(tuple, again.collect()), key=repr) == sorted(map(tuple, dimension.collect()), key=repr)


def test_type_1_changes_reach_all_versions_and_only_their_parts(spark, ts, rows, tmp_path):
    path = str(tmp_path / "dim")
    source = [(i, f"n{i}", ts(day)) for i in range(60) for day in (1, 2)]
    before = splice_dimension(spark, path, spark.createDataFrame(source, VERSIONS), "id", "key", parts=16)
    old, stamps = rows(before), files(path)
    changes = spark.createDataFrame([(4, "changed"), (5, None), (999, "unknown"), (None, "none")], "id int, name string")
    found = rows(overwrite_attributes(spark, path, changes, "id"))
    expected = [(k, i, {4: "changed", 5: None}.get(i, n), *rest) for k, i, n, *rest in old]
    assert found == sorted(expected, key=repr)
    assert sum(files(path).get(f) == stamps[f] for f in stamps) >= 13
    with pytest.raises(ValueError, match="several changes"):
        overwrite_attributes(spark, path, spark.createDataFrame([(4, "a"), (4, "b")], PAIRS.replace("v ", "name ")), "id")


def test_a_load_that_fails_is_given_the_same_rows_again(spark, ts, rows, tmp_path):
    state, path = str(tmp_path / "state"), str(tmp_path / "t")
    source = spark.createDataFrame([(i, f"v{i}", ts(i)) for i in range(10)], VERSIONS)
    given = []

    def merge(window):
        given.append([r[0] for r in rows(window, "id")])
        merge_table(spark, path, window, ["id"])

    def fail(window):
        merge(window)
        raise InterruptedError

    assert stored_cutoff(spark, state, "t") is None
    load_by_cutoff(spark, state, "t", source, "valid_from", "2020-01-04", merge)
    with pytest.raises(InterruptedError):
        load_by_cutoff(spark, state, "t", source, "valid_from", "2020-01-07", fail)
    assert stored_cutoff(spark, state, "t") == "2020-01-04 00:00:00"
    load_by_cutoff(spark, state, "t", source, "valid_from", "2020-01-08", merge)
    assert load_by_cutoff(spark, state, "t", source, "valid_from", "2020-01-02", fail) == "2020-01-08 00:00:00"
    assert given == [[0, 1, 2, 3], [4, 5, 6], [4, 5, 6, 7]]
    assert rows(whole(read_parts(spark, path)), "id") == [(i,) for i in range(8)]
    assert stored_cutoff(spark, state, "other") is None
    assert read_loads(spark, state).where(F.col("cutoff_time") == ts_literal("2020-01-08")).count() == 1


def test_a_load_killed_before_its_pointer_leaves_a_readable_table(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    os.makedirs(f"{path}/_loads")
    assert load_names(spark, path) == [] and read_loads(spark, path) is None
    assert rows(append_load(spark.createDataFrame([(1, "a")], PAIRS), path)) == [(1, "a")]
