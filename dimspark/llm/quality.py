"""Quality rules (operator 3).

Base rules reject documents that are short or mostly repeat themselves. The rest
is judged by how its words are distributed: unigrams and bigrams are hashed into
buckets, a trusted and a raw multinomial over the buckets are counted from the
corpus, and a document's score is its log-likelihood ratio between the two,
divided by its number of n-grams. Every document with a score under the
threshold is rejected.

The raw counts cover every document. Trusted documents are those whose labels all
say so, and all of them count. Their ids are broadcast up to ``most_broadcast``; beyond
that the documents are joined with them by a shuffle, once, and written. A hash deals
them to two folds, each of which has a trusted multinomial. A trusted document is scored
by the fold that has not seen it, any other by the mean of both. The trusted scores
set the threshold: their ``quantile``, less ``margin`` of its distance from their
median. Multinomials have as many rows as there are buckets, and a trusted one is
smoothed towards the raw one by a share of its own size, so that scores and threshold
mean the same at every size of the corpus.

Defined results: a NULL text has no words and fails; a NULL id is never trusted;
repeated rows are counted and judged each; without trusted documents every score
is 0 and passes; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimspark.llm.slices import with_number
from dimspark.llm.text import per_text
from dimspark.operators.joins import left_join
from dimspark.operators.ordering import order_rows
from dimspark.sources.shared import store

BUCKETS = 1 << 16
MOST_BROADCAST = 500_000
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\r\x0b\x0c"

MEASURES = [
    ("n_words", "bigint"),
    ("word_chars", "bigint"),
    ("n_symbols", "bigint"),
    ("n_dup_lines", "bigint"),
    ("n_repeat_words", "bigint"),
]

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _numbered(words: list[bytes]) -> tuple[np.ndarray, dict[bytes, int]]:
    """The words as numbers in order of first occurrence."""
    numbers: dict[bytes, int] = {}
    return np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64), numbers


def _ngram_buckets(words: np.ndarray, numbers: dict[bytes, int], buckets: int) -> np.ndarray:
    """The bucket of each unigram and bigram."""
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in numbers), dtype=np.uint64, count=len(numbers))[words]
    pairs = (hashes[:-1] * _GOLDEN) ^ (hashes[1:] >> np.uint64(7))
    grams = np.concatenate([hashes, pairs * _GOLDEN])
    return ((grams >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def _repeat_words(words: np.ndarray, distinct: int) -> int:
    """Words in 3-word windows that occur twice or more."""
    if len(words) < 4:
        return 0
    pairs = words[:-1] * distinct + words[1:]
    if distinct > 1 << 20:  # keep the product of three below 2**63
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, which, counts = np.unique(pairs[:-1] * distinct + words[2:], return_inverse=True, return_counts=True)
    repeated = counts[which] > 1
    covered = np.zeros(len(words), dtype=bool)
    for shift in range(3):
        covered[shift : shift + len(repeated)] |= repeated
    return int(covered.sum())


def _dup_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return len(lines) - len(set(lines))


def measures(text: str, words: np.ndarray, distinct: int) -> tuple[int, int, int, int, int]:
    """The columns of ``MEASURES``."""
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        _dup_lines(text),
        _repeat_words(words, distinct),
    )


def trusted_ids(labels: DataFrame, most_trusted: int | None = None) -> DataFrame:
    """(``_id``, ``_fold``) of all trusted documents; with ``most_trusted``, of about as many, chosen by a hash."""
    rows = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("_quality"))
    good = rows.where("_quality = 1").select(F.col("doc_id").alias("_id"))
    fold = F.pmod(F.xxhash64(F.lit("half"), "_id"), F.lit(2)).cast("int")
    if most_trusted is not None:
        share = min(1.0, most_trusted / max(good.count(), 1))
        place = F.pmod(F.xxhash64(F.lit("trusted"), "_id"), F.lit(1 << 32))
        good = good.where(place < F.lit(int(share * (1 << 32))))
    return good.select("_id", fold.alias("_fold"))


def with_folds(docs: DataFrame, trusted: DataFrame, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """``docs`` with ``__fold``, which is NULL unless ``trusted`` has the id. Rows are neither lost nor repeated."""
    trusted = store(trusted.withColumnsRenamed({"_id": "__trusted", "_fold": "__fold"}))
    if trusted.count() <= most_broadcast:
        return docs.join(F.broadcast(trusted), F.col("doc_id") == F.col("__trusted"), "left").drop("__trusted")
    # Three readers follow; written, the texts are shuffled for the first only.
    return store(left_join(docs, trusted, "doc_id", "__trusted", ["text"]).drop("__trusted"))


def quantiles(values: DataFrame, column: str, shares: list[float]) -> list[float] | None:
    """Exact quantiles of ``column``, interpolated as ``percentile`` does; None without rows.

    The values are sorted across slices and looked up by number, so that no task holds them all.
    """
    ordered = order_rows(store(values.select(column)), [F.col(column)])
    last = ordered.count() - 1
    if last < 0:
        return None
    places = [last * share for share in shares]
    wanted = sorted({whole for place in places for whole in (math.floor(place), math.ceil(place))})
    rows = with_number(ordered, "_number").where(F.col("_number").isin(wanted)).select("_number", column)
    at = dict(map(tuple, rows.collect()))

    def between(place: float) -> float:
        low, high = math.floor(place), math.ceil(place)
        return at[low] if at[low] == at[high] else (high - place) * at[low] + (place - low) * at[high]

    return [between(place) for place in places]


def bucket_counts(texts: DataFrame, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Raw n-gram counts of a (``text``, ``_fold``) table, and those of its two folds, summed in each task first."""

    def count(batches):
        import pyarrow as pa

        raw, trusted = np.zeros(buckets, dtype=np.int64), np.zeros((2, buckets), dtype=np.int64)
        for batch in batches:
            for text, fold in zip(batch.column("text"), batch.column("_fold").to_pylist(), strict=True):
                words, numbers = _numbered((text.as_py() or "").encode().split())
                if len(words):
                    found = np.bincount(_ngram_buckets(words, numbers, buckets), minlength=buckets)
                    raw += found
                    if fold is not None:
                        trusted[fold] += found
        seen = np.flatnonzero(raw)
        arrays = [pa.array(values[seen]) for values in (np.arange(buckets), raw, *trusted)]
        yield pa.RecordBatch.from_arrays(arrays, names=["bucket", "raw", "first", "second"])

    counts = texts.mapInArrow(count, "bucket bigint, raw bigint, first bigint, second bigint")
    rows = counts.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in ("raw", "first", "second")]).collect()
    raw, trusted = np.zeros(buckets), np.zeros((2, buckets))
    for bucket, n_raw, *n_trusted in rows:
        raw[bucket], trusted[:, bucket] = n_raw, n_trusted
    return raw, trusted


def log_ratios(raw: np.ndarray, trusted: np.ndarray, smoothing: float = 0.1) -> np.ndarray:
    """Log of trusted to raw probability of each bucket.

    The trusted multinomial is smoothed towards the raw one by ``smoothing`` times its
    own n-grams. Without trusted n-grams the two are equal.
    """
    p_raw = (raw + 1) / (raw.sum() + len(raw))
    mass = trusted.sum()
    if not mass:
        return np.zeros(len(raw))
    p_trusted = (trusted / mass + smoothing * p_raw) / (1 + smoothing)
    return np.log(p_trusted / p_raw)


def judge(
    docs: DataFrame,
    labels: DataFrame,
    buckets: int = BUCKETS,
    most_trusted: int | None = None,
    quantile: float = 0.005,
    margin: float = 0.1,
    smoothing: float = 0.1,
    min_words: int = 50,
    most_repeated_percent: int = 50,
    keep_text: bool = True,
    most_broadcast: int = MOST_BROADCAST,
) -> DataFrame:
    """``docs`` with ``MEASURES``, ``base_failed``, ``score`` and ``kept``.

    An input column of one of these names is replaced. Without ``keep_text`` the
    text doesn't come back from the tasks. All trusted documents count unless
    ``most_trusted`` is given.
    """
    spark = docs.sparkSession
    added = [*[name for name, _ in MEASURES], "base_failed", "score", "kept"]
    docs = docs.select(*[c for c in docs.columns if c.lower() not in added])
    flagged = with_folds(docs, trusted_ids(labels, most_trusted), most_broadcast)
    raw, counted = bucket_counts(flagged.select("text", F.col("__fold").alias("_fold")), buckets)
    shared = spark.sparkContext.broadcast([log_ratios(raw, fold, smoothing) for fold in counted])

    def build():
        ratios = shared.value

        def of(text: str) -> tuple:
            words, numbers = _numbered(text.encode().split())
            if not len(words):
                return (*measures(text, words, 0), 0.0, 0.0)
            found = _ngram_buckets(words, numbers, len(ratios[0]))
            return (*measures(text, words, len(numbers)), *[float(ratio[found].mean()) for ratio in ratios])

        return of

    fields = [*MEASURES, ("__first", "double"), ("__second", "double")]
    failed: Column = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > most_repeated_percent * F.col("n_words"))
    unseen = F.when(F.col("__fold") == 0, F.col("__second")).when(F.col("__fold") == 1, F.col("__first"))
    score = F.coalesce(unseen, (F.col("__first") + F.col("__second")) / 2)
    held_out = per_text(flagged.where("__fold IS NOT NULL").select("text", "__fold"), "text", fields, build).where(~failed)
    # Exact, so that it doesn't depend on the order of tasks.
    found = quantiles(held_out.select(score.alias("score")), "score", [quantile, 0.5])
    threshold = min(found[0] - margin * (found[1] - found[0]), 0.0) if found else 0.0
    judged = per_text(flagged, "text", fields, build, keep_text).withColumn("base_failed", failed).withColumn("score", score)
    kept = ~F.col("base_failed") & (F.col("score") >= F.lit(threshold))
    return judged.withColumn("kept", kept).select(*[c for c in docs.columns if keep_text or c != "text"], *added)
