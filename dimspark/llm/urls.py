"""URL filters with a weighted vocabulary (operator 4).

Rules by host and path come first; the longest that fits decides. For the rest an
Aho-Corasick automaton finds all terms of the vocabulary in one pass over the url.
A hit counts if no letter or digit touches it on either side. One strict term
rejects, and so do ``most_soft`` or more distinct soft ones.

A vocabulary may also come as a table (``term``, ``weight``): a url is rejected if the
weights of its distinct terms reach ``most_soft``, so a term of that weight is strict
and one of weight 1 soft. Its terms are sent to the tasks in blocks of bounded size,
which is one block up to ``block_chars`` characters. Terms that are NULL or empty, or
weigh nothing, never count; a term that stands in several rows has its largest weight.

Defined results: a NULL url, or one without ``://``, has an empty host and path,
fits no rule and is judged by its terms; a term found twice counts once; repeated
rows get a row each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

import ahocorasick
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimspark.llm.text import ROW, packed, per_text, unpacked
from dimspark.sources.shared import store

# Fixed values of the filter: (host, path) rules, and the two weights of terms.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
STRICT = ["casino", "escorts", "hentai", "jackpot", "malware", "phishing", "porn", "viagra", "warez", "xxx"]
SOFT = [
    "ads", "adult", "bet", "bets", "bonus", "cheap", "clickbait", "deals", "doorway", "farm", "free",
    "loans", "pills", "poker", "promo", "sex", "slots", "spam", "track", "tracker", "win",
]

BLOCK_CHARS = 10_000_000

ADDED = ["host", "path", "rule", "verdict"]


def _after_scheme() -> Column:
    url = F.coalesce(F.col("url"), F.lit(""))
    return F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")


def with_host_and_path(pages: DataFrame) -> DataFrame:
    rest = _after_scheme()
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    beyond = F.expr("substring(_rest, length(_raw_host) + 1)")
    return (
        pages.withColumn("_rest", rest)
        .withColumn("_raw_host", host)
        .withColumn("path", F.regexp_extract(beyond, r"^[^?#]*", 0))
        .withColumn("host", F.translate("_raw_host", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        .drop("_rest", "_raw_host")
    )


def _fits(host: str, path: str) -> Column:
    same = (F.col("host") == host) | F.col("host").endswith("." + host)
    return same & F.col("path").startswith(path)


def term_finder(terms: Iterable[tuple[str, object]]) -> Callable[[str], dict]:
    """Build the automaton; returns a function from a text to the values of the terms with boundaries in it."""
    automaton = ahocorasick.Automaton()
    for term, value in terms:
        automaton.add_word(term, (term, value))
    automaton.make_automaton()

    def touches(text: str, at: int) -> bool:
        return 0 <= at < len(text) and text[at].isalnum()

    def of(text: str) -> dict:
        if not len(automaton):
            return {}
        hits = ((end, *found) for end, found in automaton.iter(text))
        return {term: value for end, term, value in hits if not touches(text, end + 1) and not touches(text, end - len(term))}

    return of


def term_counter(strict: Sequence[str], soft: Sequence[str]) -> Callable[[str], tuple[int, int]]:
    """A function from a url to the numbers of its distinct strict and soft terms."""
    find = term_finder((term.lower(), weight) for weight, terms in (("soft", soft), ("strict", strict)) for term in terms)

    def of(url: str) -> tuple[int, int]:
        found = list(find(url.lower()).values())
        return found.count("strict"), found.count("soft")

    return of


def _weighed(rows: DataFrame, vocabulary: DataFrame, block_chars: int) -> DataFrame:
    """``rows`` with ``weight``, the sum over the distinct terms of ``vocabulary`` in ``url``; ``url`` goes."""
    weight = F.col("weight").cast("bigint")
    terms = vocabulary.select(F.lower("term").alias("term"), weight.alias("weight")).where("length(term) > 0 AND weight > 0")
    terms = store(terms.groupBy("term").agg(F.max("weight").alias("weight")))
    size, longest = terms.agg(F.coalesce(F.sum(F.length("term")), F.lit(0)), F.coalesce(F.max(F.length("term")), F.lit(0))).first()
    blocks = max(1, -(-size // block_chars))
    while True:
        number = F.pmod(F.xxhash64("term"), F.lit(blocks))
        largest = terms.groupBy(number.alias("b")).agg(F.sum(F.length("term")).alias("n")).agg(F.max("n")).first()[0] or 0
        if largest <= 2 * block_chars + longest:
            break
        blocks *= 2

    def weigh(rows: DataFrame, block: int) -> DataFrame:
        own = rows.sparkSession.sparkContext.broadcast([tuple(r) for r in terms.where(number == block).collect()])

        def build():
            find = term_finder(own.value)
            return lambda text: (sum(find(text).values()),)

        return per_text(rows, "url", [("weight", "bigint")], build)

    # Lowered as the terms were, so that both agree on every letter.
    rows = rows.withColumn("url", F.lower("url"))
    if blocks == 1:
        return weigh(rows, 0)
    # Terms are distinct, so the sums over blocks add up.
    rows = store(rows.withColumn("_n", F.monotonically_increasing_id()))
    parts = [store(weigh(rows.select("_n", "url"), block).where("weight > 0")) for block in range(blocks)]
    sums = reduce(DataFrame.unionByName, parts).groupBy("_n").agg(F.sum("weight").alias("weight"))
    return rows.drop("url").join(sums, "_n", "left").withColumn("weight", F.coalesce("weight", F.lit(0).cast("bigint")))


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = tuple(RULES),
    strict: Sequence[str] = tuple(STRICT),
    soft: Sequence[str] = tuple(SOFT),
    most_soft: int = 2,
    vocabulary: DataFrame | None = None,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` (block or allow).

    ``vocabulary``, a table of terms and weights, takes the place of ``strict`` and
    ``soft``. An input column named like an added one is replaced.
    """
    named = with_host_and_path(pages.select(packed(pages), "url"))
    if vocabulary is None:
        fields = [("n_strict", "bigint"), ("n_soft", "bigint")]
        counted = per_text(named, "url", fields, lambda: term_counter(strict, soft))
        rejected = (F.col("n_strict") > 0) | (F.col("n_soft") >= most_soft)
    else:
        counted = _weighed(named, vocabulary, block_chars)
        rejected = F.col("weight") >= most_soft
    by_length = sorted(rules, key=lambda r: -len(r[0] + r[1]))
    rule = decision = F.lit(None).cast("string")
    for host, path, action in reversed(by_length):
        rule = F.when(_fits(host, path), host + path).otherwise(rule)
        decision = F.when(_fits(host, path), action).otherwise(decision)
    verdict = F.coalesce(decision, F.when(rejected, "block").otherwise("allow"))
    judged = counted.select(ROW, "host", "path", rule.alias("rule"), verdict.alias("verdict"))
    return judged.select(*unpacked(pages.columns, ADDED))
