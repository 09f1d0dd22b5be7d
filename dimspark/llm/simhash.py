"""SimHash near-duplicates by covering locality-sensitive hashing (operator 6).

A fingerprint has a bit for each of the 64 bits of a shingle's hash, set if more
than half of the text's shingle hashes have it set. Fingerprints at ``radius`` or
fewer differing bits are linked.

Candidates come from structured bit masks. Each bit position gets a non-zero
vector of radius + 1 bits, and each non-zero vector ``v`` a mask of the positions
whose vector has an odd product with ``v``. Any ``radius`` positions leave some
``v`` at right angles to all their vectors, so some mask holds none of them: a
pair within the radius is equal under that mask and meets in its table. No pair is
missed, whatever the data.

Only distinct fingerprints are compared, so copies cost nothing. A bucket of more
than ``LARGEST`` fingerprints isn't compared but divided by a further set of
masks over other vectors. The same argument holds inside it, so again no pair is
lost. Each division fixes four sevenths of the free bits (for radius 2); after
``LEVELS`` of them so few are free that a bucket is small by construction. Within
a bucket the links are reduced to a spanning forest before they leave the task.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimspark.llm.components import components
from dimspark.llm.text import ROW, packed, per_text, unpacked
from dimspark.sources.shared import store

LARGEST = 256
LEVELS = 3
SEED = 42


def fingerprint(text: str, shingle: int = 3) -> int:
    """The fingerprint as a signed 64-bit number; 0 if there are no words."""
    words = text.encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])
    width = min(shingle, len(words))
    spans = zip(starts[: len(words) - width + 1].tolist(), (ends[width - 1 :] - 1).tolist(), strict=True)
    hashes = np.array([xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in spans], dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for part in range(0, len(hashes), 8192):
        block = hashes[part : part + 8192].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


def with_fingerprint(docs: DataFrame, shingle: int = 3, keep_text: bool = False) -> DataFrame:
    """``docs`` with the column ``fp``, in place of the text unless it is kept."""
    return per_text(docs, "text", [("fp", "bigint")], lambda: lambda text: (fingerprint(text, shingle),), keep_text)


def covering_masks(radius: int, level: int) -> list[int]:
    """One 64-bit mask for each non-zero vector of ``radius + 1`` bits, as signed numbers."""
    vectors = (1 << (radius + 1)) - 1

    def vector(bit: int) -> int:
        row, column = divmod(bit, vectors)
        return 1 + (column if level == 0 else row + (level - 1) * column) % vectors

    masks = []
    for v in range(1, vectors + 1):
        mask = sum(1 << bit for bit in range(64) if (vector(bit) & v).bit_count() % 2)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return masks


def _spanning_links(radius: int):
    """A function from a bucket's fingerprints to links (larger, smaller) that connect what is close.

    Every fingerprint is compared with those not reached yet, one row at a time.
    """

    def of(values: list[int]) -> list[dict[str, int]]:
        fps = np.unique(np.array(values, dtype=np.int64))
        bits, waiting = fps.view(np.uint64), np.ones(len(fps), dtype=bool)
        links = []
        for start in range(len(fps)):
            reached = [start] if waiting[start] else []
            waiting[start] = False
            while reached:
                at = reached.pop()
                close = np.flatnonzero(waiting & (np.bitwise_count(bits ^ bits[at]) <= radius))
                waiting[close] = False
                reached.extend(close.tolist())
                links += [{"u": max(int(fps[at]), int(fps[c])), "v": min(int(fps[at]), int(fps[c]))} for c in close]
        return links

    return of


def close_links(fps: DataFrame, radius: int = 2, largest: int = LARGEST) -> DataFrame:
    """Links (``u``, ``v``) that connect all distinct fingerprints ``fp`` within ``radius`` bits."""
    import pyarrow as pa

    link_type = pa.list_(pa.struct([("u", pa.int64()), ("v", pa.int64())]))

    def spans(batches):
        of = _spanning_links(radius)
        for batch in batches:
            links = [of(x.as_py()) for x in batch.column("fps")]
            yield pa.RecordBatch.from_arrays([pa.array(links, link_type)], names=["links"])

    rows = fps.select("fp", F.lit(0).cast("bigint").alias("mask"), F.lit(0).alias("path"))
    found = []
    for level in range(LEVELS):
        masks = covering_masks(radius, level)
        tables = F.array(*[F.struct(F.lit(i + 1).alias("i"), F.lit(m).cast("bigint").alias("m")) for i, m in enumerate(masks)])
        rows = (
            rows.withColumn("_t", F.explode(tables))
            .withColumn("mask", F.col("mask").bitwiseOR(F.col("_t.m")))
            .withColumn("path", F.col("path") * (len(masks) + 1) + F.col("_t.i"))
            .select("fp", "mask", "path", F.col("fp").bitwiseAND(F.col("mask")).alias("bucket"))
        )
        buckets = store(
            rows.groupBy("path", "bucket")
            .agg(F.count("*").alias("n"), F.min("fp").alias("low"), F.max("fp").alias("high"))
            .where("n > 1")
        )
        apart = F.bit_count(F.col("low").bitwiseXOR(F.col("high")))
        found.append(buckets.where(F.col("n") == 2).where(apart <= radius).select(F.col("high").alias("u"), F.col("low").alias("v")))
        last = level == LEVELS - 1
        compared = buckets.where("n > 2" if last else f"n > 2 AND n <= {largest}").select("path", "bucket")
        lists = rows.join(compared, ["path", "bucket"], "left_semi").groupBy("path", "bucket").agg(F.collect_list("fp").alias("fps"))
        links = lists.select("fps").mapInArrow(spans, "links array<struct<u: bigint, v: bigint>>")
        found.append(links.select(F.explode("links").alias("l")).select("l.u", "l.v"))
        divided = buckets.where(f"n > {largest}").select("path", "bucket")
        if last or divided.isEmpty():
            break
        rows = store(rows.join(divided, ["path", "bucket"], "left_semi")).select("fp", "mask", "path")
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    return links.distinct()


def linked(rows: DataFrame, radius: int = 2) -> DataFrame:
    """(``fp``, ``first``): the smallest ``one`` in the component of each fingerprint of a (``fp``, ``one``) table."""
    classes = store(rows.groupBy("fp").agg(F.min("one").alias("one")))
    roots = store(components(close_links(classes, radius)))
    placed = classes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root"), "one")
    grouped = placed.join(roots.select(F.col("root").alias("fp")).distinct().select(F.col("fp").alias("_r")), F.col("root") == F.col("_r"), "left")
    alone = grouped.where("_r IS NULL").select("fp", F.col("one").alias("first"))
    together = store(grouped.where("_r IS NOT NULL").select("fp", "root", "one"))
    firsts = together.groupBy("root").agg(F.min("one").alias("first")).withColumnRenamed("root", "_root")
    return alone.unionByName(together.join(firsts, F.col("root") == F.col("_root")).select("fp", "first"))


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of every document.

    ``component_id`` is the smallest doc_id that can be reached over links, the
    document's own included. Defined results: a NULL or empty text has fingerprint
    zero and is linked like any other; a NULL id is never smallest and keeps its
    row; repeated rows keep theirs; an empty table gives an empty result.
    """
    rows = store(with_fingerprint(docs.select("doc_id", "text"), shingle))
    found = linked(rows.select("fp", F.col("doc_id").alias("one")), radius).withColumnRenamed("fp", "_fp")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.join(found, F.col("fp") == F.col("_fp")).select(
        "doc_id", digits.alias("fingerprint"), F.col("first").alias("component_id")
    )


def one_of_each(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """One document of each component: the one with the smallest id, NULL last; the columns of ``docs``.

    The numbers that tell rows apart are written with them, so they stay what they
    are if a task runs again.
    """
    rows = docs.select(packed(docs), F.col("doc_id").alias("_id"), "text")
    numbered = with_fingerprint(rows, shingle).withColumn("_n", F.monotonically_increasing_id())
    rows = store(numbered)
    one = F.struct(F.col("_id").isNull().alias("last"), F.col("_id").alias("id"), F.col("_n").alias("n"))
    firsts = linked(rows.select("fp", one.alias("one")), radius).select(F.col("first.n").alias("_n")).distinct()
    return rows.join(firsts, "_n", "left_semi").select(*unpacked(docs.columns, []))
