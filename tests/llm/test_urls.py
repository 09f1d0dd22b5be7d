import random
import re

import plain
import pytest

from dimspark.llm.urls import RULES, SOFT, STRICT, judge_urls, term_counter

SCHEMA = "page_id long, url string"


def verdicts(spark, urls):
    df = spark.createDataFrame(list(enumerate(urls)), SCHEMA)
    return {r["url"]: r for r in judge_urls(df).collect()}


def test_rules_by_host_and_path(spark):
    found = verdicts(
        spark,
        [
            "http://a.net/", "http://net/x", "http://a.net", "http://anet/", "https://EXAMPLE.net/en/1", "https://m.example.net/EN/1",
            "http://example.com/de/", "http://x.example.com/de/2#t", "http://notexample.com/de/2", "http://b.org/fr/1?x=/de/",
            "http://a.net:80/", "HTTP://B.ORG/fr/", "no scheme", None, "x://", "http://a.org?y://c.net/",
        ],
    )
    rules = {url: r["rule"] for url, r in found.items()}
    assert rules == {
        "http://a.net/": "net/", "http://net/x": "net/", "http://a.net": None, "http://anet/": None,
        "https://EXAMPLE.net/en/1": "example.net/en/", "https://m.example.net/EN/1": "net/", "http://example.com/de/": "example.com/de/",
        "http://x.example.com/de/2#t": "example.com/de/", "http://notexample.com/de/2": None, "http://b.org/fr/1?x=/de/": "org/fr/",
        "http://a.net:80/": None, "HTTP://B.ORG/fr/": "org/fr/", "no scheme": None, None: None, "x://": None,
        "http://a.org?y://c.net/": None,
    }
    actions = {h + p: a for h, p, a in RULES}
    assert all(r["verdict"] == actions[r["rule"]] for r in found.values() if r["rule"])
    assert (found["https://m.example.net/EN/1"]["host"], found["https://m.example.net/EN/1"]["path"]) == ("m.example.net", "/EN/1")
    assert (found[None]["host"], found[None]["path"], found[None]["verdict"]) == ("", "", "allow")


def test_terms_need_boundaries_and_count_once(spark):
    count = term_counter(STRICT, SOFT)
    assert count("http://www.Cheap-Pills.example.com/") == (0, 2)
    assert count("http://casinos.com/xcasino/casino1") == (0, 0)
    assert count("http://a.com/casino") == (1, 0)
    assert count("http://free.free.com/free") == (0, 1)
    found = verdicts(spark, ["http://free.com/", "http://free.com/bets", "http://adsorb.com/track", "http://x.com/a_porn_b", "spam farm"])
    assert [found[u]["verdict"] for u in found] == ["allow", "block", "allow", "block", "block"]


def test_each_soft_term_against_a_plain_search(spark):
    urls = [f"http://h{i}.com/{a}{sep}{b}" for i, (a, b) in enumerate(zip(SOFT, SOFT[1:] + STRICT[:1])) for sep in ("/", "x", "-9")]
    found = verdicts(spark, urls)
    for url in urls:
        hits = {t for t in STRICT + SOFT if re.search(rf"(?<![^\W_]){t}(?![^\W_])", url)}
        assert (found[url]["verdict"] == "block") == (bool(hits & set(STRICT)) or len(hits) > 1), url


def test_messy_rows(spark):
    df = plain.messy_docs(spark).withColumnRenamed("text", "url").withColumnRenamed("doc_id", "page_id")
    judged = judge_urls(df)
    assert judged.count() == df.count() and judged.where("host = 'x'").count() == 0 and "kept" in judged.columns
    assert judge_urls(df.limit(0)).count() == 0


@pytest.mark.parametrize("block_chars", [10_000_000, 40, 1])
def test_a_table_of_weights_against_a_plain_search(spark, block_chars):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(30)] + ["Straße", "ÉTÉ", "w1-w2", "w3/w4"]
    weights = {w.lower(): rng.choice([1, 1, 2, 3]) for w in words}
    terms = [(w, n) for w, n in weights.items()] + [("W5", 9), ("w5", 1), (None, 3), ("", 3), ("w29x", 0), ("w28x", None)]
    weights["w5"] = 9
    urls = [None, "", "://"]
    for _ in range(200):
        parts = rng.choices([*words, "x", "w1w2", "w29x", "w28x", "straße"], k=rng.randrange(1, 6))
        urls.append(f"http://{rng.choice('abc')}.example.edu/" + "".join(p + rng.choice("/-_x.") for p in parts))
    pages = spark.createDataFrame(list(enumerate(urls)), SCHEMA).repartition(3)
    vocabulary = spark.createDataFrame(terms, "term string, weight int")
    judged = judge_urls(pages, rules=(), most_soft=4, vocabulary=vocabulary, block_chars=block_chars)
    found = {r["page_id"]: r["verdict"] for r in judged.collect()}
    def total(url):
        return sum(n for t, n in weights.items() if re.search(rf"(?<![^\W_]){re.escape(t)}(?![^\W_])", url.lower()))

    assert found == {i: "block" if total(url or "") >= 4 else "allow" for i, url in enumerate(urls)}
    assert set(found.values()) == {"block", "allow"}


def test_weights_give_what_the_two_lists_give(spark):
    urls = [f"http://h.edu/{a}/{b}" for a, b in zip([*SOFT, *STRICT], ["x", *SOFT, *STRICT])]
    pages = spark.createDataFrame(list(enumerate(urls)), SCHEMA)
    vocabulary = spark.createDataFrame([(t, 2) for t in STRICT] + [(t, 1) for t in SOFT], "term string, weight int")
    weighed = judge_urls(pages, vocabulary=vocabulary).select("page_id", "verdict").collect()
    assert sorted(weighed) == sorted(judge_urls(pages).select("page_id", "verdict").collect())


def test_an_empty_vocabulary_and_messy_rows(spark):
    df = plain.messy_docs(spark).withColumnRenamed("text", "url").withColumnRenamed("doc_id", "page_id")
    none = spark.createDataFrame([], "term string, weight int")
    assert judge_urls(df, rules=(), vocabulary=none).where("verdict = 'allow'").count() == df.count()
    some = spark.createDataFrame([("word1", 2), ("word2", 1)], "term string, weight int")
    assert judge_urls(df, vocabulary=some, block_chars=1).count() == df.count()
    assert judge_urls(df.limit(0), vocabulary=some).count() == 0
