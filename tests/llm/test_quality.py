import random

import numpy as np
import plain
import pytest

from dimspark.llm import quality

DOCS, LABELS = "doc_id long, text string", "doc_id long, quality int, toxic int"
MEASURES = [name for name, _ in quality.MEASURES]


def test_measures_equal_the_plain_version(spark):
    rng = random.Random(3)
    texts = [t for _, t, _ in plain.messy_rows()]
    texts += [" ".join(rng.choice("ab c# *| éü x".split(" ")) for _ in range(rng.choice([1, 2, 3, 4, 80]))) for _ in range(60)]
    texts += ["a b c\na b c\n \n\na b c\r\n", "x\x85y z w", "q\x0bq\x0cq q q"]
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
    judged = quality.judge(docs, spark.createDataFrame([], LABELS))
    for r in judged.collect():
        expected = plain.quality_measures(r["text"])
        assert tuple(r[m] for m in MEASURES) == expected
        failed = expected[0] < 50 or 100 * expected[4] > 50 * expected[0]
        # Without labels nothing tells documents apart, so the base rules decide.
        assert r["base_failed"] == failed and r["kept"] == (not failed) and r["score"] == 0.0


def test_counts_cover_all_documents(spark):
    texts = [t for _, t, _ in plain.messy_rows()]
    folds = [(None, 0, 1)[i % 3] for i in range(len(texts))]
    docs = spark.createDataFrame(list(zip(texts, folds)), "text string, _fold int")
    raw, trusted = quality.bucket_counts(docs.repartition(5), 64)
    expected = np.zeros((3, 64))
    for text, fold in zip(texts, folds):
        words, numbers = quality._numbered((text or "").encode().split())
        if len(words):
            found = np.bincount(quality._ngram_buckets(words, numbers, 64), minlength=64)
            expected += np.array([found, found * (fold == 0), found * (fold == 1)])
    assert (raw == expected[0]).all() and (trusted == expected[1:]).all()


def test_smoothing_does_not_depend_on_the_size_of_the_corpus():
    rng = np.random.default_rng(1)
    raw = rng.integers(1000, 5000, 64).astype(float)
    trusted = np.floor(raw * rng.random(64))
    small, large = quality.log_ratios(raw, trusted), quality.log_ratios(1000 * raw, 1000 * trusted)
    assert np.abs(small - large).max() < 0.01
    assert (quality.log_ratios(raw, np.zeros(64)) == 0).all()


def test_held_out_labels_of_the_given_documents(spark):
    """Of labelled documents that pass the base rules, bad ones go and good ones stay; no label of a document decides its own verdict."""
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    judged = quality.judge(docs, labels, keep_text=False).where("NOT base_failed").join(labels, "doc_id")
    verdicts = {quality_label: [r["kept"] for r in judged.where(f"quality = {quality_label}").collect()] for quality_label in (0, 1)}
    assert len(verdicts[0]) >= 20 and sum(verdicts[0]) <= 0.5 * len(verdicts[0])
    assert sum(verdicts[1]) >= 0.95 * len(verdicts[1])


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(1)
    good, bad = ([f"{w}{i}" for i in range(80)] for w in ("good", "junk"))
    docs, labels = [], []
    for i in range(300):
        pool = bad if i % 6 == 0 else good
        docs.append((i, " ".join(rng.choice(pool) for _ in range(70))))
        if i % 2 == 0:
            labels.append((i, int(i % 6 != 0), 0))
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)


def test_unlike_documents_go_and_clean_ones_stay(corpus):
    judged = quality.judge(*corpus, buckets=1 << 12).collect()
    assert [r["doc_id"] for r in judged if not r["kept"]] == [r["doc_id"] for r in judged if r["doc_id"] % 6 == 0]


def test_verdicts_agree_between_runs(corpus):
    docs, labels = corpus
    one = {tuple(r) for r in quality.judge(docs, labels, keep_text=False).collect()}
    assert one == {tuple(r) for r in quality.judge(docs.repartition(6), labels, keep_text=False).collect()}


def test_trusted_ids_are_bounded_and_need_agreeing_labels(spark):
    rows = [(i, 1, 0) for i in range(2000)] + [(1, 0, 0), (None, 1, 0), (3000, None, 0), (2, 1, 1)]
    labels = spark.createDataFrame(rows, LABELS)
    ids = {r["_id"] for r in quality.trusted_ids(labels, 10_000).collect()}
    assert ids == set(range(2000)) - {1}
    assert 50 < quality.trusted_ids(labels, 100).count() < 160


def test_all_trusted_documents_count(spark):
    labels = spark.range(120_000).selectExpr("id AS doc_id", "1 AS quality", "0 AS toxic")
    docs = spark.range(120_000).selectExpr("id AS doc_id", "concat('w', id % 7) AS text")
    assert quality.trusted_ids(labels).count() == 120_000
    flagged = quality.with_folds(docs, quality.trusted_ids(labels))
    assert flagged.count() == flagged.where("__fold IS NOT NULL").count() == 120_000


def test_judging_takes_no_share_of_the_trusted_documents(spark, monkeypatch):
    asked = []
    ids = quality.trusted_ids
    monkeypatch.setattr(quality, "trusted_ids", lambda labels, most=None: asked.append(most) or ids(labels, most))
    quality.judge(spark.createDataFrame([(1, "a")], DOCS), spark.createDataFrame([(1, 1, 0)], LABELS))
    assert asked == [None]


def test_trusted_ids_beyond_the_broadcast_give_the_same(spark, corpus):
    docs, labels = corpus
    docs = docs.union(docs.limit(20)).union(spark.createDataFrame([(None, "good1 " * 3), (None, None)], DOCS))
    small, large = (sorted(map(tuple, quality.judge(docs, labels, most_broadcast=most).collect()), key=repr) for most in (1000, 0))
    assert small == large and len(small) == 322


def test_quantiles_are_those_of_percentile(spark):
    rng = random.Random(5)
    for n in (0, 1, 2, 3, 1001):
        values = spark.createDataFrame([(rng.choice([rng.random(), 0.5]),) for _ in range(n)], "score double")
        expected = values.selectExpr("percentile(score, array(0.005, 0.5, 0.9))").first()[0]
        assert quality.quantiles(values, "score", [0.005, 0.5, 0.9]) == expected


def test_empty_tables_and_clashing_columns(spark):
    labels = spark.createDataFrame([], LABELS)
    assert quality.judge(spark.createDataFrame([], DOCS), labels).count() == 0
    docs = plain.messy_docs(spark)
    judged = quality.judge(docs, labels)
    assert judged.count() == docs.count() and judged.where("_n = 'x' AND host = 'x'").count() == docs.count()
