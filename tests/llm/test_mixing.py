from collections import defaultdict

import plain
import pytest
from pyspark.sql import functions as F

from dimspark.llm.mixing import mix, mixed_documents

SCHEMA = "doc_id long, text string, source string"


def check(rows, mixed):
    expected = plain.targets([(s, len(plain.words(t))) for _, t, s in rows])
    sizes = sorted((d if d is not None else -1, len(plain.words(t))) for d, t, _ in rows)
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["size"]) for r in mixed) == sizes
    taken = defaultdict(int)
    for r in mixed:
        size, target = expected[r["source"]]
        assert r["source_size"] == size and plain.near(r["target"], target)
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for source, (_, target) in expected.items():
        assert taken[source] == int(target + 1e-9)


def test_each_source_is_cut_at_its_budget(spark):
    rows = plain.messy_rows()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    mixed = mix(docs).collect()
    check(rows, mixed)
    again = mix(docs.repartition(3)).collect()
    assert sorted(map(str, mixed)) == sorted(map(str, again))


def test_a_hot_source_and_small_sources_that_fill_up(spark):
    rows = [(i, "a b c d e f g h i j", "hot") for i in range(300)]
    rows += [(1000 + i, "one two", f"s{i}") for i in range(40)]
    check(rows, mix(spark.createDataFrame(rows, SCHEMA)).collect())


def test_other_seeds_take_other_documents(spark):
    docs = spark.createDataFrame([(i, "a b c", "ab"[i % 5 == 0]) for i in range(200)], SCHEMA)
    one, two = ({r["doc_id"] for r in mix(docs, seed=s).where("source = 'a' AND taken > 0").collect()} for s in (1, 2))
    assert one and one != two


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "", "a"), (2, None, "b")], [(1, "x", None)] * 4])
def test_empty_tables_and_texts(spark, rows):
    check(rows, mix(spark.createDataFrame(rows, SCHEMA)).collect()) if rows else None
    assert mix(spark.createDataFrame(rows, SCHEMA)).count() == len(rows)


def test_columns_with_clashing_names_survive(spark):
    docs = plain.messy_docs(spark)
    mixed = mix(docs)
    assert sorted(mixed.columns) == sorted(set(docs.columns) | {"size", "source_size", "target", "taken"})
    assert mixed.where("_key = 'x' AND _source = 'x' AND kept = 'x'").count() == docs.count()
    assert mixed_documents(docs).columns == docs.columns


def test_whole_documents_come_as_often_as_they_are_taken(spark):
    docs = spark.createDataFrame(plain.messy_rows(), SCHEMA)
    plan = mix(docs).where("size > 0").groupBy("doc_id", "text").agg(F.sum(F.round(F.col("taken") / F.col("size"))).cast("long").alias("n"))
    wanted = {(r["doc_id"], r["text"]): r["n"] for r in plan.where("n > 0").collect()}
    found = {(r["doc_id"], r["text"]): r["count"] for r in mixed_documents(docs).groupBy("doc_id", "text").count().collect()}
    assert found == wanted
