import hashlib
import random

import plain
import pytest

from dimspark.llm import pii

SCHEMA = "doc_id long, text string"


def check(rows, found):
    assert len(found) == len(rows)
    texts = {i: t for i, t in rows}
    for r in found:
        spans = plain.personal_data(texts[r["doc_id"]])
        written = ",".join(f"{pii.KINDS[k]}:{start}:{end}" for start, k, end in spans)
        assert r["base_sha256"] == hashlib.sha256(written.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[1] == k for s in spans) for k in range(4)]
        assert set(filter(None, written.split(","))) <= set(r["spans"].split(","))


def test_base_spans_equal_the_plain_version(spark):
    rng = random.Random(1)
    marks = "0123456789 -.@+()ab \n%é😀"
    texts = ["".join(rng.choice(marks) for _ in range(rng.choice([5, 30, 300]))) for _ in range(600)]
    texts += [None, "", "x 4111111111111111 y 4111 1111 1111 1111. 256.1.1.1 001.2.3.255 +1 (017) 555-7713"]
    texts += ["a@b.c.d@e.f", "1.2.3.4.5.6.7.8", "0.0.0.0256", "+1 (0", "4111-1111-1111-1111-0", "++12345678901 +"]
    rows = list(enumerate(texts))
    check(rows, pii.find_personal_data(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect())


@pytest.mark.parametrize("piece, times", [("1", 30_000), ("1 ", 60_000), ("a", 40_000), ("a@", 30_000), ("1.2.3.4 ", 20_000), ("+1 ", 30_000)])
def test_very_long_texts(spark, piece, times):
    rows = [(1, piece * times)]
    check(rows, pii.find_personal_data(spark.createDataFrame(rows, SCHEMA)).collect())


def test_contexts_discover_identifiers_without_a_base_form(spark):
    rows = [(i, f"lorem w{i} phone: +1 (017) 555-{1000 + i} and mail me at a{i}@b{i}.com ok") for i in range(8)]
    rows += [(100, "my phone: 0171 5557713 and mail me at bob@localhost ok"), (101, "count 5557713 items"), (102, "phone: yes")]
    found = {r["doc_id"]: r for r in pii.find_personal_data(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found[100]["spans"] == "phone:10:22,email:38:51" and found[100]["n_added"] == 2
    assert found[101]["spans"] == found[102]["spans"] == ""
    assert all(found[i]["n_added"] == 0 for i in range(8))


def test_contexts_that_hold_anything_discover_nothing(spark):
    rows = [(i, f"the +1 (017) 555-{1000 + i} x") for i in range(5)] + [(10 + i, f"the {i}00200300 x") for i in range(9)]
    found = pii.find_personal_data(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sum(r["n_added"] for r in found) == 0


def test_repeated_rows_nulls_and_empty_tables(spark):
    rows = [(1, "mail a@b.co"), (1, "mail a@b.co"), (None, "mail a@b.co"), (None, None)]
    found = pii.find_personal_data(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((str(r["doc_id"]), r["n_email"]) for r in found) == [("1", 1), ("1", 1), ("None", 0), ("None", 1)]
    assert pii.find_personal_data(spark.createDataFrame([], SCHEMA)).count() == 0
    assert pii.find_personal_data(plain.messy_docs(spark)).count() == len(plain.messy_rows())


def test_the_main_path_has_no_python(spark):
    docs = spark.createDataFrame([(1, "mail a@b.co")], SCHEMA)
    for df in (pii._matched(docs), pii.find_personal_data(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan


def test_identifiers_in_lists_beside_others_and_behind_labels(spark):
    rows = [(i, f"lorem w{i} phone: +1 (017) 555-{1000 + i} and mail me at a{i}@b{i}.com ok") for i in range(40)]
    rows += [(100, "my phone: 0171 5557713 " + " ".join(str(10_000 + i) for i in range(10)) + " ok")]
    rows += [(101, "my phone: 0171 5557714 a@b.com ok"), (102, "my phone:5557715 ok"), (103, "see a@b.com phone: 5557716 a@b.com")]
    rows += [(104, "my phone: 01 71 55 57 71 3 ok")]
    found = {r["doc_id"]: r for r in pii.find_personal_data(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found[104]["spans"] == "phone:10:26"
    assert found[100]["spans"] == "phone:10:22"
    assert found[101]["spans"] == "phone:10:22,email:23:30"
    assert found[102]["spans"] == "phone:9:16"
    assert found[103]["spans"] == "email:4:11,phone:19:26,email:27:34"


@pytest.mark.parametrize("unseen", [5, 60, 600])
def test_unseen_identifiers_do_not_speak_against_their_pattern(spark, unseen):
    rows = [(i, f"call phone: +49 (017) 555-{1000 + i} now please") for i in range(30)]
    rows += [(1000 + i, f"call phone: 0171 {5550000 + i} now please") for i in range(unseen)]
    found = pii.find_personal_data(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["spans"] for r in found if r["doc_id"] >= 1000} == {"phone:12:24"}


def test_contexts_of_many_seeds_that_hold_other_forms_discover_nothing(spark):
    rows = [(i, f"the +1 (017) 555-{1000 + i} x") for i in range(30)] + [(100 + i, f"the {i}00200300 x") for i in range(30)]
    rows += [(200 + i, f"the {i} x") for i in range(40)] + [(300 + i, f"the a{i}@b.com x") for i in range(10)]
    found = pii.find_personal_data(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sum(r["n_added"] for r in found) == 0


def test_a_number_of_single_digits_is_reported_whole(spark):
    rows = [(i, f"lorem w{i} phone: +1 (017) 555-{1000 + i} ok") for i in range(40)]
    rows += [(100, "my phone: 0 1 7 1 5 5 5 7 7 1 3 ok"), (101, "my phone: 0 1 7 1 5 5 5 7 7 1 3 4 4 4 4, ok")]
    found = {r["doc_id"]: r["spans"] for r in pii.find_personal_data(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found[100] == "phone:10:31" and found[101] == "phone:10:39"


def loosely(text):
    """Phone-like parts of up to four tokens behind the word ``tel``, in plain Python."""
    import re

    spans = []
    for m in re.finditer(r"(?<!\S)tel ((?:[0-9()/.+-]+ ?)+)", text):
        run = m[1].rstrip()
        if 7 <= len(re.sub(r"\D", "", run)) <= 15 and re.fullmatch(r"[+(]?[0-9][0-9 ()./-]*[0-9]", run):
            spans.append((m.start(1), m.start(1) + len(run)))
    return spans


def test_planted_identifiers_without_a_base_form_are_found_and_nothing_else(spark):
    """All identifiers behind their word, in random documents, and no number elsewhere."""
    rng = random.Random(11)
    words = [f"w{c}" for c in "abcdefghijklmnopqrstuvwxyz"]
    rows = []
    for i in range(300):
        text = [rng.choice(words) for _ in range(rng.randint(3, 30))]
        for _ in range(rng.randint(0, 2)):
            kind = rng.random()
            if kind < 0.3:
                text += ["tel", f"+49 (0171) 55{rng.randrange(10_000):05d}"]
            elif kind < 0.6:
                text += ["tel", rng.choice([f"0171/55{rng.randrange(10_000):05d}", f"0171 {rng.randrange(10**6, 10**7)}", f"(0171) {rng.randrange(10**6, 10**7)}"])]
            else:
                text += [rng.choice(words), str(rng.randrange(10 ** rng.randint(1, 9)))]
            text += [rng.choice(words)]
        rows.append((i, " ".join(text)))
    found = {r["doc_id"]: r for r in pii.find_personal_data(spark.createDataFrame(rows, SCHEMA)).collect()}
    planted = missed = 0
    for i, text in rows:
        base = {(s, e) for s, _, e in plain.personal_data(text)}
        added = {tuple(map(int, span.split(":")[1:])) for span in filter(None, found[i]["spans"].split(","))} - base
        expected = {span for span in loosely(text) if not any(s < span[1] and span[0] < e for s, e in base)}
        planted, missed = planted + len(expected), missed + len(expected - added)
        assert added <= expected
    assert planted > 50 and missed == 0
