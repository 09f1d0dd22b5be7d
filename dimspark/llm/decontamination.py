"""Benchmark decontamination by a prefix-filtered join of shingle sets (operator 5).

An item's text is cut into windows of ``window`` consecutive words; a shorter item
is one window. A window is contained in a document if all its shingles (runs of
``shingle`` words) are, in order. For a containment of 1 a prefix of one shingle is
enough, so each window is joined by its rarest shingle alone; rarity is the number
of occurrences in all documents. A match gives the only place where the window can
lie: the length bound asks that the document has as many words, the positional
bound that the window begins and ends inside it. What passes is compared word by
word over the item-sized window.

A benchmark of at most ``broadcast_words`` words is sent to the tasks, and documents
never move. Beyond that, documents are shuffled by what can match: a bitmap of
bounded size says which of their shingles can be a window's, these are counted, and
the runs of words around rarest shingles are joined with the windows and compared
there. Both ways give the same rows, and both read the documents a fixed number of
times whatever the benchmark's size. Long items are cut into overlapping pieces.

Defined results: a NULL or empty text, of a document or an item, has no words and
matches nothing; items with the same text all count; items
without an id count like others for hits and contamination, and together as one
item in ``n_items``, but have no place in ``items_sha256``; repeated document rows
get a row each; an empty benchmark leaves all documents clean.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimspark.llm.text import ROW, packed, per_text, unpacked
from dimspark.sources.shared import store

WINDOW = 13
SHINGLE = 5
BROADCAST_WORDS = 200_000
PIECE = 10_000
# The bitmap of shingles has 16 bits for each, but never more than 64 MB; if that is
# too few, more runs of words are shuffled that match nothing.
BITS_EACH = 16
MOST_BITS = 29
# Rows of an Arrow batch that a task makes from a text, however long.
ROWS_AT_ONCE = 20_000

FOUND = [("n_words", "bigint"), ("hits", "array<bigint>"), ("items", "array<string>")]
ADDED = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]

# Upper case is lowered; all bytes that are no digit, letter or part of a character
# beyond ASCII become spaces.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(_FOLD).split()


def _numbers(words: list[bytes], vocabulary: dict[bytes, int]) -> np.ndarray:
    """Each word's number, 0 for words that are in no item."""
    get = vocabulary.get
    return np.array([get(w, 0) for w in words], dtype=np.uint64)


def _shingles(numbers: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` words; equal runs have equal hashes."""
    n = max(len(numbers) - width + 1, 0)
    hashes = np.full(n, width, dtype=np.uint64)
    for i in range(width):
        hashes = (hashes ^ numbers[i : i + n]) * _PRIME
        hashes ^= hashes >> np.uint64(29)
    return hashes


def _known(numbers: np.ndarray, width: int) -> np.ndarray:
    """Places of the runs of ``width`` words that all occur in items."""
    known = np.concatenate([[0], np.cumsum(numbers != 0)])
    return np.flatnonzero(known[width:] - known[:-width] == width) if len(numbers) >= width else np.zeros(0, dtype=np.int64)


def _ordered(items: set[str | None]) -> list[str | None]:
    """By id; the item without one is last."""
    return sorted(items, key=lambda item: (item is None, item or ""))


class Block:
    """Windows of some items, and how to find them in a text."""

    def __init__(self, pieces: list[tuple[str | None, list[bytes]]], window: int, shingle: int):
        self.window, self.shingle = window, shingle
        self.vocabulary: dict[bytes, int] = {}
        windows: dict[tuple[int, ...], set[str | None]] = {}
        for item, words in pieces:
            numbers = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            for at in range(max(len(numbers) - window, 0) + 1):
                windows.setdefault(tuple(numbers[at : at + window]), set()).add(item)
        self.windows = [(np.array(w, dtype=np.uint64), _ordered(items)) for w, items in windows.items()]
        self.widths = sorted({self.width(len(w)) for w, _ in self.windows})
        self.prefixes: dict[int, list[tuple[int, int]]] = {}

    def width(self, length: int) -> int:
        return min(self.shingle, length)

    def shingles(self) -> np.ndarray:
        """The distinct shingles of all windows, sorted."""
        parts = [_shingles(w, self.width(len(w))) for w, _ in self.windows]
        return np.unique(np.concatenate(parts)) if parts else np.zeros(0, dtype=np.uint64)

    def counter(self, shingles: np.ndarray):
        """A function from a text to the numbers of its shingles in ``shingles``."""

        def of(text: str) -> np.ndarray:
            numbers = _numbers(words_of(text), self.vocabulary)
            found = []
            for width in self.widths:
                hashes = _shingles(numbers, width)[_known(numbers, width)]
                places = np.minimum(np.searchsorted(shingles, hashes), len(shingles) - 1)
                found.append(places[shingles[places] == hashes])
            return np.concatenate(found)

        return of

    def choose_prefixes(self, shingles: np.ndarray, occurrences: np.ndarray) -> None:
        """Index each window by the shingle that occurs least, with the shingle's place in the window."""
        for number, (words, _) in enumerate(self.windows):
            own = _shingles(words, self.width(len(words)))
            at = int(np.argmin(occurrences[np.searchsorted(shingles, own)]))
            self.prefixes.setdefault(int(own[at]), []).append((number, at))

    def matcher(self):
        """A function from a text to its number of words, its hit places and the items found."""
        index = np.sort(np.fromiter(self.prefixes, dtype=np.uint64, count=len(self.prefixes)))

        def of(text: str) -> tuple[int, list[int], list[str | None]]:
            words = words_of(text)
            if not len(index) or not words:
                return len(words), [], []
            numbers = _numbers(words, self.vocabulary)
            hit, items = np.zeros(len(words), dtype=bool), set()
            for width in self.widths:
                known = _known(numbers, width)
                hashes = _shingles(numbers, width)[known]
                places = np.minimum(np.searchsorted(index, hashes), len(index) - 1)
                for i in np.flatnonzero(index[places] == hashes):
                    for number, offset in self.prefixes[int(hashes[i])]:
                        window, of_items = self.windows[number]
                        start = int(known[i]) - offset
                        fits = start >= 0 and start + len(window) <= len(numbers)
                        if fits and np.array_equal(numbers[start : start + len(window)], window):
                            hit[start : start + len(window)] = True
                            items.update(of_items)
            return len(words), np.flatnonzero(hit).tolist(), _ordered(items)

        return of


def benchmark_pieces(benchmark: DataFrame, window: int) -> DataFrame:
    """The items cut into distinct pieces that overlap by a window."""

    def cut(batches):
        for batch in batches:
            rows = []
            for item, text in zip(batch.column("item"), batch.column("text"), strict=True):
                words = words_of(text.as_py() or "")
                for at in range(0, max(len(words) - window, 0) + 1, PIECE):
                    part = words[at : at + PIECE + window - 1]
                    if part:
                        rows.append((item.as_py(), len(part), b" ".join(part)))
            columns = list(zip(*rows, strict=True)) or [()] * 3
            kinds = [pa.string(), pa.int64(), pa.binary()]
            names = ["item", "n", "words"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    named = benchmark.select(F.col("item_id").cast("string").alias("item"), "text")
    return store(named.mapInArrow(cut, "item string, n bigint, words binary").distinct())


def _occurrences(docs: DataFrame, block: Block, shingles: np.ndarray) -> np.ndarray:
    """How often each shingle occurs in all documents, summed in each task first."""
    shared = docs.sparkSession.sparkContext.broadcast((block, shingles))

    def count(batches):
        block, shingles = shared.value
        of, total = block.counter(shingles), np.zeros(len(shingles), dtype=np.int64)
        for batch in batches:
            for text in batch.column("text"):
                total += np.bincount(of(text.as_py() or ""), minlength=len(shingles))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["shingle", "n"])

    occurrences = np.zeros(len(shingles), dtype=np.int64)
    if len(shingles):
        counts = docs.select("text").mapInArrow(count, "shingle bigint, n bigint")
        for shingle, n in counts.groupBy("shingle").agg(F.sum("n")).collect():
            occurrences[shingle] = n
    return occurrences


def _found(rows: DataFrame, block: Block) -> DataFrame:
    """``rows`` with ``n_words``, ``hits`` and ``items`` for one block, the text kept."""
    shingles = block.shingles()
    block.choose_prefixes(shingles, _occurrences(rows, block, shingles))
    shared = rows.sparkSession.sparkContext.broadcast(block)
    return per_text(rows, "text", FOUND, lambda: shared.value.matcher())


def _hashed(words: list[bytes]) -> np.ndarray:
    """A hash of each word that is the same in every task."""
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))


def _batch(columns: Sequence[tuple[str, object, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(values, kind) for _, values, kind in columns], names=[c[0] for c in columns])


def _windows(pieces: DataFrame, window: int) -> DataFrame:
    """Distinct (item, window), the window's words joined by spaces."""

    def cut(batches):
        for batch in batches:
            for item, words in zip(batch.column("item"), batch.column("words"), strict=True):
                words = words.as_py().decode().split(" ")
                texts = [" ".join(words[at : at + window]) for at in range(max(len(words) - window, 0) + 1)]
                yield _batch([("item", [item.as_py()] * len(texts), pa.string()), ("window", texts, pa.string())])

    return store(pieces.mapInArrow(cut, "item string, window string").distinct())


def _window_shingles(windows: DataFrame, shingle: int) -> DataFrame:
    """The shingles of each distinct window, with their places and the number of words of both."""

    def cut(batches):
        for batch in batches:
            rows = []
            for text in batch.column("window").to_pylist():
                numbers = _hashed(text.encode().split(b" "))
                width = min(shingle, len(numbers))
                hashes = _shingles(numbers, width).view(np.int64).tolist()
                rows += [(text, at, len(numbers), width, h) for at, h in enumerate(hashes)]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            yield _batch(list(zip(["window", "at", "length", "width", "hash"], columns, kinds, strict=True)))

    distinct = windows.select("window").distinct()
    return store(distinct.mapInArrow(cut, "window string, at bigint, length bigint, width bigint, hash bigint"))


def _bitmap(hashes: DataFrame, bits: int) -> np.ndarray:
    """``2**bits`` bits, set where the first ``bits`` bits of a hash point; built in parts, whatever the number of hashes."""
    slot = F.shiftrightunsigned("hash", 64 - bits) + 1
    parts = hashes.groupBy(F.bitmap_bucket_number(slot).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("set")
    )
    found = np.zeros(max(2**bits // 8, 4096), dtype=np.uint8)
    for part, values in parts.toLocalIterator():
        found[(part - 1) * 4096 : part * 4096] = np.frombuffer(bytes(values), dtype=np.uint8)
    return found


def _places(numbers: np.ndarray, width: int, bitmap: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the shingles that the bitmap holds."""
    hashes = _shingles(numbers, width)
    slots = hashes >> np.uint64(64 - bits)
    at = np.flatnonzero((bitmap[slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype(np.uint8)) & 1)
    return at, hashes[at]


def _counted(docs: DataFrame, widths: list[int], bitmap: np.ndarray, bits: int) -> DataFrame:
    """How often each shingle that the bitmap holds occurs in all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def count(batches):
        for batch in batches:
            for text in batch.column("text"):
                numbers = _hashed(words_of(text.as_py() or ""))
                for width in widths:
                    hashes, n = np.unique(_places(numbers, width, shared.value, bits)[1], return_counts=True)
                    yield _batch([("hash", hashes.view(np.int64), pa.int64()), ("n", n, pa.int64())])

    return store(docs.select("text").mapInArrow(count, "hash bigint, n bigint").groupBy("hash").agg(F.sum("n").alias("n")))


def _surroundings(docs: DataFrame, window: int, widths: list[int], bitmap: np.ndarray, bits: int) -> DataFrame:
    """Runs of words, wide enough for a window on either side, around shingles that the bitmap holds."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def cut(batches):
        for batch in batches:
            for number, text in zip(batch.column("_n").to_pylist(), batch.column("text"), strict=True):
                words = words_of(text.as_py() or "")
                numbers = _hashed(words)
                for width in widths:
                    places, hashes = _places(numbers, width, shared.value, bits)
                    for i in range(0, len(places), ROWS_AT_ONCE):
                        at = places[i : i + ROWS_AT_ONCE]
                        before = np.minimum(at, window - width)
                        spans = zip((at - before).tolist(), (at + window).tolist(), strict=True)
                        around = [b" ".join(words[a:b]).decode() for a, b in spans]
                        yield _batch(
                            [
                                ("_n", [number] * len(at), pa.int64()),
                                ("place", at, pa.int64()),
                                ("before", before, pa.int64()),
                                ("around", around, pa.string()),
                                ("hash", hashes[i : i + ROWS_AT_ONCE].view(np.int64), pa.int64()),
                            ]
                        )

    return docs.select("_n", "text").mapInArrow(cut, "_n bigint, place bigint, before bigint, around string, hash bigint")


def _joined(rows: DataFrame, pieces: DataFrame, window: int, shingle: int) -> DataFrame:
    """``n_words``, ``n_hit`` and ``items`` of all ``rows``, by joins of shingles with windows."""
    rows = store(per_text(rows.withColumn("_n", F.monotonically_increasing_id()), "text", [("n_words", "bigint")], lambda: _n_words, True))
    windows = _windows(pieces, window)
    shingles = _window_shingles(windows, shingle)
    widths = [r["width"] for r in shingles.select("width").distinct().collect()]
    bits = min(max(int(BITS_EACH * shingles.count()).bit_length(), 15), MOST_BITS)

    # The rarest shingle of each window; a window with a shingle that no document holds is in none.
    counts = _counted(rows, widths, _bitmap(shingles, bits), bits)
    often = F.coalesce(F.col("n"), F.lit(0))
    rarest = shingles.join(counts, "hash", "left").groupBy("window").agg(F.min(F.struct(often.alias("n"), "at", "hash", "length")).alias("r"))
    prefixes = store(rarest.where("r.n > 0").select("window", "r.at", "r.hash", "r.length"))

    # Bounds by position and length, then the words themselves.
    around = _surroundings(rows, window, widths, _bitmap(prefixes, bits), bits)
    words, first = F.split("around", " "), F.col("before") - F.col("at")
    fits = (first >= 0) & (first + F.col("length") <= F.size(words))
    same = F.when(fits, F.array_join(F.slice(words, (first + 1).cast("int"), F.col("length").cast("int")), " ") == F.col("window"))
    start = F.col("place") - F.col("at")
    matches = store(around.join(prefixes, "hash").where(same).select("_n", start.alias("start"), (start + F.col("length")).alias("end"), "window"))

    # Words that no match before has covered, in the order of the matches' starts.
    earlier = Window.partitionBy("_n").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.col("end") - F.greatest(F.col("start"), F.coalesce(F.max("end").over(earlier), F.lit(0))), F.lit(0))
    hits = matches.select("_n", fresh.alias("fresh")).groupBy("_n").agg(F.sum("fresh").alias("n_hit"))
    held = matches.select("_n", "window").distinct().join(windows, "window").select("_n", "item").distinct()
    items = held.groupBy("_n").agg(F.collect_list(F.struct("item")).alias("i")).select("_n", F.array_sort("i.item").alias("items"))
    return (
        rows.drop("text")
        .join(hits, "_n", "left")
        .join(items, "_n", "left")
        .withColumn("n_hit", F.coalesce("n_hit", F.lit(0).cast("bigint")))
        .withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
    )


def _n_words(text: str) -> tuple[int]:
    return (len(words_of(text)),)


def _digest(items: Column) -> Column:
    """Of the ids; an item without one is left out."""
    return F.sha2(F.array_join(items, ","), 256)


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    shingle: int = SHINGLE,
    broadcast_words: int = BROADCAST_WORDS,
    least_share: float = 0.05,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``docs`` with ``ADDED``; a document is contaminated if ``least_share`` of its words are hit, or more.

    ``keep`` names the columns to carry, all if it is None; one named like an added
    column is replaced.
    """
    rows = docs.select(packed(docs, keep), "text")
    per_hit = int(round(1 / least_share))
    pieces = benchmark_pieces(benchmark, window)
    if (pieces.agg(F.sum("n")).first()[0] or 0) <= broadcast_words:
        block = Block([(r["item"], bytes(r["words"]).split()) for r in pieces.collect()], window, shingle)
        merged = _found(rows, block).withColumn("n_hit", F.size("hits").cast("bigint"))
    else:
        merged = _joined(rows, pieces, window, shingle)
    n_hit = F.col("n_hit")
    return merged.select(
        ROW,
        "n_words",
        n_hit,
        F.size("items").cast("bigint").alias("n_items"),
        _digest(F.col("items")).alias("items_sha256"),
        ((n_hit > 0) & (per_hit * n_hit >= F.col("n_words"))).alias("contaminated"),
    ).select(*unpacked(keep or docs.columns, ADDED))

