"""Merkle dataset manifest: a SHA midstate tree (operator 11).

Every row is a leaf. The leaves of a group, in order, are hashed in runs of eight
until one digest remains, and the digests of the groups likewise give the root. A
digest is 64 characters of hex, one block of SHA-256, so the state of a parent's
hash before a child slot is its chaining value and nothing else. A parent keeps the
states before all of its slots. Folding a changed leaf resumes the state before its
slot with the new digest and the siblings to the right; siblings to the left are
never hashed again.

A tree is built in blocks of 8**4 nodes, each of which a task holds alone; the roots
of the blocks are the nodes of the next round, so a group with a third of all rows is
as many blocks as it needs, and rounds grow with the logarithm of the rows. Parents
are rows of a table. To fold a block its leaves meet the parents inside it and the
one path above it.

Defined results: a NULL field counts as ``-``; equal ids, and repeated rows, are
ordered by leaf and each is a leaf; NULL ids come first; NULL groups are one group,
the first; an empty table gives an empty result; columns of the input never clash, as
they travel in a struct, and a result column replaces an input column of its name.
A group costs a task some hundredths of a second, however small it is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimspark.llm import sha256
from dimspark.llm.slices import with_number, with_rank
from dimspark.llm.text import ROW, packed, unpacked
from dimspark.operators.ordering import order_rows
from dimspark.sources.shared import store

# The children of a node, and the fields of a document's leaf.
ARITY = 8
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]

# Levels, and nodes, of a block. One task holds a block.
DEPTH = 4
BLOCK = ARITY**DEPTH

# Levels of the tree over groups are numbered from here, above those of any group.
FOREST = 1000

PARENTS = "__tree string, __block bigint, __n bigint, level int, index bigint, digest string, children array<string>, states array<binary>, top boolean"
ADDED = ["subroot", "root", "proof_sha256", "folded_root", "verified"]


def leaf_hash(fields: Sequence[Column]) -> Column:
    """The hash of a row: each field as its length in UTF-8 bytes, a colon and its text, or ``-`` if NULL."""

    def written(field: Column) -> Column:
        text = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[written(f) for f in fields]).cast("binary"), 256)


@dataclass(frozen=True)
class Manifest:
    """Leaves with their places, and the parents of all trees with their states."""

    leaves: DataFrame
    parents: DataFrame
    forest: DataFrame
    forest_parents: DataFrame
    columns: Sequence[str]


def _hex(values: pa.Array) -> np.ndarray:
    """Digests as (n, 64) bytes."""
    return np.frombuffer("".join(values.to_pylist()).encode(), dtype=np.uint8).reshape(-1, sha256.BLOCK)


def _texts(digests: np.ndarray) -> list[str]:
    joined = digests.tobytes().decode()
    return [joined[i : i + sha256.BLOCK] for i in range(0, len(joined), sha256.BLOCK)]


def _levels(n: int) -> int:
    """Levels of a block of a tree of ``n`` nodes: all where further blocks exist, else up to one node."""
    levels, nodes = 0, min(n, BLOCK)
    while nodes > 1 or (n > BLOCK and levels < DEPTH):
        levels, nodes = levels + 1, -(-nodes // ARITY)
    return levels


def _parent_states(children: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The states (p, 8, 8) before each child slot and the digests (p, 64), from children (p, 8, 64)."""
    states = np.zeros((len(children), ARITY, 8), dtype=np.uint32)
    state = sha256.starts(len(children))
    for slot in range(int(counts.max())):
        states[:, slot] = state
        here = counts > slot
        state[here] = sha256.advance(state[here], children[here, slot])
    return states, sha256.finish(state, counts)


def _block_parents(tree: str, block: int, n: int, base: int, digests: np.ndarray):
    """The rows of ``PARENTS`` of one block, whose nodes are at level ``base``."""
    levels = _levels(n)
    if not levels:
        yield tree, block, n, base, block, _texts(digests)[0], [], [], True
    for level in range(1, levels + 1):
        parents = -(-len(digests) // ARITY)
        counts = np.full(parents, ARITY)
        counts[-1] = len(digests) - ARITY * (parents - 1)
        children = np.zeros((parents * ARITY, sha256.BLOCK), dtype=np.uint8)
        children[: len(digests)] = digests
        states, made = _parent_states(children.reshape(parents, ARITY, sha256.BLOCK), counts)
        first = block * BLOCK // ARITY**level
        below, names = _texts(digests), _texts(made)
        for p, count in enumerate(counts.tolist()):
            kept = [states[p, slot].astype(">u4").tobytes() for slot in range(count)]
            yield tree, block, n, base + level, first + p, names[p], below[p * ARITY : p * ARITY + count], kept, level == levels
        digests = made


def _round(nodes: DataFrame, base: int) -> DataFrame:
    """Parents within blocks of (``__tree``, ``__index``, ``__n``, ``__digest``) nodes, which are at level ``base``."""
    cut = nodes.withColumn("__block", F.expr(f"__index div {BLOCK}"))
    together = cut.repartition("__tree", "__block").sortWithinPartitions("__tree", "__block", "__index")

    def build(batches):
        def written(rows):
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        names = ["__tree", "__block", "__n", "level", "index", "digest", "children", "states", "top"]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.list_(pa.string()), pa.list_(pa.binary()), pa.bool_()]
        at, held = None, []
        for batch in batches:
            keys = list(zip(*[batch.column(c).to_pylist() for c in ("__tree", "__block", "__n")], strict=True))
            digests = _hex(batch.column("__digest")) if keys else None
            begin = 0
            for end in range(1, len(keys) + 1):
                if end == len(keys) or keys[end] != keys[begin]:
                    if at != keys[begin] and held:
                        yield written(list(_block_parents(*at, base, np.concatenate(held))))
                        held = []
                    at = keys[begin]
                    held.append(digests[begin:end])
                    begin = end
        if held:
            yield written(list(_block_parents(*at, base, np.concatenate(held))))

    return together.select("__tree", "__block", "__n", "__digest").mapInArrow(build, PARENTS)


def _trees(nodes: DataFrame) -> DataFrame:
    """Parents of all levels, round by round."""
    rounds: list[DataFrame] = []
    while True:
        parents = store(_round(nodes, DEPTH * len(rounds)))
        rounds.append(parents)
        nodes = parents.where(f"top AND __n > {BLOCK}").select(
            "__tree", F.col("__block").alias("__index"), F.expr(f"(__n + {BLOCK - 1}) div {BLOCK}").alias("__n"), F.col("digest").alias("__digest")
        )
        if nodes.isEmpty():
            return reduce(DataFrame.unionByName, rounds)


def _paths(nodes: DataFrame, parents: DataFrame, base: int, highest: int) -> DataFrame:
    """``nodes`` (``__tree``, ``__index``; at level ``base``), one row for each parent above, with their slot in it."""
    levels = F.sequence(F.lit(base + 1), F.lit(max(highest, base + 1)))
    power = F.pow(F.lit(float(ARITY)), F.col("level") - 1 - base).cast("bigint")
    placed = nodes.withColumn("level", F.explode(levels)).withColumn("__below", F.floor(F.expr("__index") / power).cast("bigint"))
    # Whole numbers below 2**53 survive the division.
    wanted = placed.select(
        *nodes.columns, "level", F.expr(f"__below div {ARITY}").alias("index"), (F.col("__below") % ARITY).cast("int").alias("slot")
    )
    above = parents.where(f"level > {base} AND size(children) > 0").select("__tree", "level", "index", "digest", "children", "states")
    return wanted.join(above, ["__tree", "level", "index"])


def build(docs: DataFrame, leaf: Column, group: Column, order: Sequence[Column], more: Sequence[Column] = ()) -> Manifest:
    """The manifest of ``docs``: a tree for each ``group``, whose leaves are sorted by ``order``, then by leaf.

    ``more`` columns, named ``__...``, travel with the leaves.
    """
    # A text for every group, the first for NULL, in the order of UTF-8 bytes.
    tree = F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))
    keys = [c.alias(f"__order{i}") for i, c in enumerate(order)]
    rows = docs.select(packed(docs), tree.alias("__tree"), *keys, leaf.alias("__digest"), *more)
    ordered = order_rows(rows, [F.col(c) for c in ("__tree", *[f"__order{i}" for i in range(len(keys))], "__digest")])
    leaves = with_rank(ordered, "__tree", "__index", "__n").drop("_slice", "_position", *[f"__order{i}" for i in range(len(keys))])
    parents = _trees(leaves.select("__tree", "__index", "__n", "__digest"))
    subroots = parents.where(f"top AND __n <= {BLOCK}").select(F.col("__tree").alias("__of"), F.col("digest").alias("__digest"))
    forest = with_number(order_rows(subroots, [F.col("__of")]), "__index", "__n").drop("_slice", "_position").withColumn("__tree", F.lit(""))
    forest = store(forest)
    return Manifest(leaves, parents, forest, _trees(forest.select("__tree", "__index", "__n", "__digest")), docs.columns)


def _fold_levels(current: np.ndarray, slots: np.ndarray, which: np.ndarray, parents: list[tuple[list[str], list[bytes]]]) -> np.ndarray:
    """Digests of parents in which the child at ``slots`` is replaced by ``current``; ``which`` parent, by number.

    The state before the slot is resumed; only the replacement and what is to its
    right are hashed.
    """
    counts = np.array([len(children) for children, _ in parents])
    digests = np.zeros((len(parents), ARITY, sha256.BLOCK), dtype=np.uint8)
    states = np.zeros((len(parents), ARITY, 8), dtype=np.uint32)
    for p, (children, kept) in enumerate(parents):
        digests[p, : len(children)] = np.frombuffer("".join(children).encode(), dtype=np.uint8).reshape(-1, sha256.BLOCK)
        states[p, : len(kept)] = np.frombuffer(b"".join(kept), dtype=">u4").reshape(-1, 8)
    state = sha256.advance(states[which, slots], current)
    for slot in range(1, int(counts.max())):
        right = (slots < slot) & (counts[which] > slot)
        if right.any():
            state[right] = sha256.advance(state[right], digests[which[right], slot])
    return sha256.finish(state, counts[which])


def _fold_block(leaves: pa.Table, above: pa.Table) -> tuple[list, ...]:
    """For each leaf of a block: subroot, root, digest of the proof and folded root."""
    places = np.array(leaves.column("__index").to_pylist(), dtype=np.int64)
    original = leaves.column("__digest").to_pylist()
    replaced = leaves.column("__replacement").to_pylist()
    current = np.frombuffer("".join(r or o for r, o in zip(replaced, original, strict=True)).encode(), dtype=np.uint8).reshape(-1, sha256.BLOCK)
    proofs: list[list[str]] = [[] for _ in original]
    subroot, root = None, None
    levels: dict[int, list[dict]] = {}
    for row in above.to_pylist():
        levels.setdefault(row["level"], []).append(row)
    for level, rows in sorted(levels.items()):
        if rows[0]["slot"] is None:  # inside the block
            number = {row["index"]: p for p, row in enumerate(rows)}
            below = places // ARITY ** (level - 1)
            which = np.array([number[i] for i in (below // ARITY).tolist()])
            slots = (below % ARITY).astype(np.int64)
        else:
            which = np.zeros(len(places), dtype=np.int64)
            slots = np.full(len(places), rows[0]["slot"])
        for proof, p, slot in zip(proofs, which.tolist(), slots.tolist(), strict=True):
            proof += rows[p]["children"][:slot]
            proof += rows[p]["children"][slot + 1 :]
        current = _fold_levels(current, slots, which, [(row["children"], row["states"]) for row in rows])
        if level < FOREST:
            subroot = rows[0]["digest"]
        root = rows[0]["digest"]
    subroots = [subroot or o for o in original]
    roots = [root or o for o in original]
    digests = [hashlib.sha256("".join(proof).encode()).hexdigest() for proof in proofs]
    return subroots, roots, digests, _texts(current)


def fold(manifest: Manifest, replacement: Column) -> DataFrame:
    """Each row with its proof, and the root that follows if its leaf is replaced (NULL: the leaf as it is).

    Adds ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root`` and ``verified``.
    """
    highest = manifest.parents.agg(F.max("level")).first()[0] or 0
    tops = manifest.parents.where(f"level <= {DEPTH} AND top").select("__tree", F.col("__block").alias("__index"))
    columns = ["__tree", "__block", "level", "index", "slot", "digest", "children", "states"]
    inside = manifest.parents.where(f"level <= {DEPTH} AND size(children) > 0").withColumn("slot", F.lit(None).cast("int"))
    higher = _paths(tops, manifest.parents, DEPTH, highest).withColumnRenamed("__index", "__block")
    top_level = manifest.forest_parents.agg(F.max("level")).first()[0] or 0
    forest = _paths(manifest.forest.select("__tree", "__index", "__of"), manifest.forest_parents, 0, top_level)
    forest = forest.select(F.col("__of").alias("__tree"), (F.col("level") + FOREST).alias("level"), "index", "slot", "digest", "children", "states")
    over = tops.withColumnRenamed("__index", "__block").join(forest, "__tree")
    above = inside.select(columns).unionByName(higher.select(columns)).unionByName(over.select(columns))

    leaves = manifest.leaves.select(
        ROW, "__tree", F.expr(f"__index div {BLOCK}").alias("__block"), "__index", "__digest", replacement.alias("__replacement")
    )

    def run(block: pa.Table, path: pa.Table) -> pa.Table:
        if not block.num_rows:
            return schema_of([[]] * 7)
        subroots, roots, proofs, folded = _fold_block(block, path)
        verified = [a == b for a, b in zip(roots, folded, strict=True)]
        row = block.column(ROW)
        return schema_of([row, block.column("__digest"), subroots, roots, proofs, folded, verified], row.type)

    def schema_of(values, row_type=None) -> pa.Table:
        names = [ROW, "leaf", *ADDED]
        if row_type is None:
            row_type = empty_row
        kinds = [row_type, *[pa.string()] * 5, pa.bool_()]
        return pa.table([v if isinstance(v, pa.ChunkedArray) else pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names=names)

    from pyspark.sql.pandas.types import to_arrow_type

    row = manifest.leaves.schema[ROW].dataType
    empty_row = to_arrow_type(row)
    added = ", ".join(f"{c} {'boolean' if c == 'verified' else 'string'}" for c in ["leaf", *ADDED])
    key = ["__tree", "__block"]
    folded = leaves.groupBy(*key).cogroup(above.groupBy(*key)).applyInArrow(run, f"{ROW} {row.simpleString()}, {added}")
    return folded.select(*unpacked(manifest.columns, ["leaf", *ADDED]))


def tampered(docs: DataFrame) -> Column:
    """The leaf of a document whose text has its A-Z lower-cased, where 3 divides the checksum of its id; else NULL."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    fields = [F.translate("text", upper, upper.lower()) if f == "text" else F.col(f) for f in FIELDS]
    return F.when(chosen, leaf_hash(fields))


def document_manifest(docs: DataFrame) -> Manifest:
    """The manifest of documents by language, and the leaves that ``tampered`` gives as ``__tampered``."""
    leaf = leaf_hash([F.col(f) for f in FIELDS])
    only = docs.select("doc_id", "lang", leaf.alias("leaf_"), tampered(docs).alias("tampered_"))
    made = build(only, F.col("leaf_"), F.col("lang"), [F.col("doc_id")], [F.col("tampered_").alias("__tampered")])
    return replace(made, columns=["doc_id", "lang"])
