"""Each stage of the pipeline against a plain version, each on its own input."""

from collections import Counter

import plain
import pytest

import corpus_pipeline
from dimspark.llm import mixing, quality

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """(input, output) rows of each stage as the pipeline runs it."""
    docs, found = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.store(stage(spark, docs, SF))
        found.append((name, docs, out))
        docs = out
    return found


def ids(rows):
    return sorted(r["doc_id"] for r in rows)


def test_columns_stay_those_of_documents(stages):
    columns = stages[0][1].columns
    assert all(out.columns == columns for _, _, out in stages[:-1])
    assert stages[-1][2].columns == [*columns, "shard", "slot"]


def test_quality_rules_drop_what_they_reject(spark, stages):
    _, docs, out = stages[0]
    judged = quality.judge(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()
    for r in judged:
        m = plain.quality_measures(r["text"])
        assert r["base_failed"] == (m[0] < 50 or 100 * m[4] > 50 * m[0]) and not (r["base_failed"] and r["kept"])
    assert ids(out.collect()) == ids(r for r in judged if r["kept"])


def test_near_dedup_keeps_one_of_each_group(stages):
    _, docs, out = stages[1]
    rows = docs.collect()
    smallest = {}
    for r, g in zip(rows, plain.components([plain.fingerprint(r["text"]) for r in rows])):
        smallest[g] = min(r["doc_id"], smallest.get(g, r["doc_id"]))
    assert ids(out.collect()) == sorted(smallest.values())


def test_decontamination_drops_contaminated_documents(spark, stages):
    _, docs, out = stages[2]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    rows = plain.contamination([(r["doc_id"], r["text"]) for r in docs.collect()], items)
    assert ids(out.collect()) == sorted(r[0] for r in rows if not r[-1])


def test_mixing_repeats_whole_documents(stages):
    _, docs, out = stages[3]
    plan = mixing.mix(docs).collect()
    goal = plain.targets([(r["source"], len(plain.words(r["text"]))) for r in docs.collect()])
    assert all(plain.near(r["target"], goal[r["source"]][1]) for r in plan)
    copies = Counter({r["doc_id"]: int(r["taken"] / max(r["size"], 1) + 0.5) for r in plan})
    assert Counter(r["doc_id"] for r in out.collect()) == +copies
    texts = {(r["doc_id"], r["text"]) for r in docs.collect()}
    assert {(r["doc_id"], r["text"]) for r in out.collect()} <= texts


def test_sharding_places_every_document(stages):
    _, docs, out = stages[4]
    rows = out.collect()
    assert ids(rows) == ids(docs.collect())
    counts = Counter(r["shard"] for r in rows)
    assert len(counts) == 16 and max(counts.values()) - min(counts.values()) <= 1
    whole = Counter(r["source"] for r in rows)
    for shard in counts:
        part = Counter(r["source"] for r in rows if r["shard"] == shard)
        assert all(abs(part[s] - n / 16) <= len(whole) / 2 + 1 for s, n in whole.items())


def test_run_gives_the_rows_of_the_last_stage(spark, stages):
    assert sorted(map(str, corpus_pipeline.run(spark, SF).collect())) == sorted(map(str, stages[-1][2].collect()))


def test_runs_share_nothing(spark, stages):
    first, second = corpus_pipeline.run(spark, SF), corpus_pipeline.run(spark, SF)
    assert sorted(map(str, first.collect())) == sorted(map(str, second.collect()))


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_empty_tables(spark, name, stage):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = stage(spark, docs.limit(0), SF)
    assert out.columns[: len(docs.columns)] == docs.columns and out.count() == 0
