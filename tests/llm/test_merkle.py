import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from dimspark.llm import merkle, sha256

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def levels(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([h("".join(found[-1][i : i + 8])) for i in range(0, len(found[-1]), 8)])
    return found


def lowered(doc_id, text):
    tampered = doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
    return re.sub("[A-Z]", lambda m: m.group().lower(), text) if tampered else text


def plain(rows):
    """Rows: (doc_id, source, lang, n_chars, text)."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append((row[0] is not None, row[0] or 0, leaf(*row), leaf(*row[:4], lowered(row[0], row[4])), row[0]))
    order = sorted(groups, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = {lang: levels([r[2] for r in sorted(groups[lang], key=lambda r: r[:3])]) for lang in groups}
    top = levels([trees[lang][-1][0] for lang in order])
    found = []
    for lang in groups:
        for place, (*_, own, changed, doc_id) in enumerate(sorted(groups[lang], key=lambda r: r[:3])):
            current, proof = changed, ""
            for tree, index in ((trees[lang], place), (top, order.index(lang))):
                for nodes in tree[:-1]:
                    run, slot = nodes[index // 8 * 8 : index // 8 * 8 + 8], index % 8
                    proof += "".join(run[:slot] + run[slot + 1 :])
                    current = h("".join([*run[:slot], current, *run[slot + 1 :]]))
                    index //= 8
            root = top[-1][0]
            found.append((doc_id, own, trees[lang][-1][0], root, h(proof), current, current == root))
    return sorted(found, key=repr)


def sample(n, langs, seed=3):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["a", "é", None]), rng.choice(langs), rng.choice([1, None]), rng.choice(["Text", "text", "", None, "Ünï X"])) for i in range(n)]
    rng.shuffle(rows)
    return rows


def run(spark, rows, **more):
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    for name, value in more.items():
        docs = docs.withColumn(name, F.lit(value))
    made = merkle.document_manifest(docs)
    return sorted((tuple(r) for r in merkle.fold(made, F.col("__tampered")).select(COLUMNS).collect()), key=repr)


def test_states_and_digests_equal_the_standard_hash():
    rng = np.random.default_rng(1)
    for blocks in (1, 2, 8):
        messages = rng.integers(0, 256, (50, 64 * blocks), dtype=np.uint8)
        state = sha256.starts(50)
        for j in range(blocks):
            state = sha256.advance(state, messages[:, 64 * j : 64 * j + 64])
        found = sha256.finish(state, np.full(50, blocks))
        assert [bytes(f).decode() for f in found] == [hashlib.sha256(bytes(m)).hexdigest() for m in messages]


@pytest.mark.parametrize("depth", [1, 2, 4])
def test_proofs_and_folds_equal_a_plain_tree(spark, monkeypatch, depth):
    # Small blocks give many rounds.
    monkeypatch.setattr(merkle, "DEPTH", depth)
    monkeypatch.setattr(merkle, "BLOCK", 8**depth)
    rows = sample(600, ["en"] * 6 + ["de", "fr", None, "", "Z", "é"]) + [(1000, "s", "only", 3, "Alone")]
    assert run(spark, rows) == plain(rows)


def test_many_groups_make_a_tree_of_several_rounds(spark, monkeypatch):
    monkeypatch.setattr(merkle, "DEPTH", 1)
    monkeypatch.setattr(merkle, "BLOCK", 8)
    rows = sample(100, [f"l{i}" for i in range(70)])
    assert run(spark, rows) == plain(rows)


def test_equal_ids_repeated_rows_null_ids_and_long_texts(spark):
    rows = [(5, "a", "en", 1, "x")] * 10 + [(5, "b", "en", 1, "X")] * 3 + [(None, "a", "en", 1, "N")] * 2
    rows += [(3, None, None, None, None), (9, "a", "en", 1, "Long Text " * 200_000)]
    assert run(spark, rows) == plain(rows)


@pytest.mark.parametrize("n", [1, 8, 9])
def test_one_group(spark, n):
    rows = sample(n, ["en"])
    assert run(spark, rows) == plain(rows)


def test_an_empty_table_gives_an_empty_result(spark):
    assert run(spark, []) == []


def test_columns_may_clash(spark):
    rows = sample(30, ["en", "de"])
    names = ["leaf", "root", "level", "states", "leaf_", "__tree", "__index", "__n", "_slice", "__row", "verified"]
    assert run(spark, rows, **{n: "x" for n in names}) == plain(rows)


def test_other_columns_stay_and_any_leaf_may_be_replaced(spark):
    docs = spark.createDataFrame([(i, f"t{i}", "keep") for i in range(20)], "id long, level string, root string")
    made = merkle.build(docs, merkle.leaf_hash([F.col("id"), F.col("level")]), F.lit("g"), [F.col("id")])
    same = merkle.fold(made, F.lit(None).cast("string")).collect()
    assert all(r.verified and r.level == f"t{r.id}" for r in same) and len(same) == 20
    assert not any(r.verified for r in merkle.fold(made, F.sha2(F.lit("other").cast("binary"), 256)).collect())


def test_parents_keep_the_state_before_each_child(spark):
    docs = spark.createDataFrame([(i,) for i in range(100)], "id long")
    made = merkle.build(docs, merkle.leaf_hash([F.col("id")]), F.lit("g"), [F.col("id")])
    for r in made.parents.where("size(children) > 0").collect():
        assert len(r.states) == len(r.children) and r.digest == h("".join(r.children))
        state = sha256.starts(1)
        for child, kept in zip(r.children, r.states, strict=True):
            assert state.astype(">u4").tobytes() == bytes(kept)
            state = sha256.advance(state, np.frombuffer(child.encode(), dtype=np.uint8).reshape(1, 64))
