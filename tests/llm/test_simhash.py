import itertools
import random
from collections import Counter

import plain
import pytest
from pyspark.sql import functions as F

from dimspark.llm import simhash
from dimspark.llm.components import components

SCHEMA = "doc_id long, text string"


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def reached(links, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for u, v in links:
        a, b = sorted((find(u), find(v)))
        root[b] = a
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("radius, level", list(itertools.product([1, 2, 3], range(simhash.LEVELS))))
def test_masks_cover_every_set_of_positions(radius, level):
    masks = [m & ((1 << 64) - 1) for m in simhash.covering_masks(radius, level)]
    assert len(masks) == 2 ** (radius + 1) - 1
    for places in itertools.combinations(range(64), radius):
        differing = sum(1 << p for p in places)
        assert any(not mask & differing for mask in masks)


def test_after_all_divisions_a_bucket_is_small():
    levels = [[m & ((1 << 64) - 1) for m in simhash.covering_masks(2, level)] for level in range(simhash.LEVELS)]
    assert max(64 - (a | b | c).bit_count() for a, b, c in itertools.product(*levels)) <= 12


@pytest.mark.parametrize("radius, largest", [(2, 256), (2, 4), (1, 8), (3, 8)])
def test_links_connect_all_close_fingerprints(spark, radius, largest):
    rng = random.Random(radius)
    fps = {rng.getrandbits(64) for _ in range(150)} | {0, (1 << 64) - 1}
    for centre in list(fps)[:12]:  # groups around a centre, chains, and pairs just too far apart
        at = centre
        for step in range(12):
            fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 3, 4]))))
            at ^= sum(1 << b for b in rng.sample(range(64), radius))
            fps.add(at)
    fps = sorted(map(signed, fps))
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    links = [(r["u"], r["v"]) for r in simhash.close_links(df, radius, largest).collect()]
    mask = (1 << 64) - 1
    near = [(a, b) for a, b in itertools.combinations(fps, 2) if ((a ^ b) & mask).bit_count() <= radius]
    assert all(((a ^ b) & mask).bit_count() <= radius for a, b in links)
    assert reached(links, fps) == reached(near, fps)


def test_a_large_group_of_near_fingerprints_gives_no_pairs_of_all(spark):
    base = 0x5DEECE66D1234567
    fps = {signed(base ^ (1 << a) ^ (1 << b)) for a, b in itertools.combinations(range(64), 2)} | {signed(base)}
    links = simhash.close_links(spark.createDataFrame([(x,) for x in fps], "fp long"))
    found = [(r["u"], r["v"]) for r in links.collect()]
    assert len(set(reached(found, fps).values())) == 1
    assert len(found) < 20 * len(fps) < len(fps) ** 2 / 10


@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(4)
    nodes = list(range(200))
    links = {
        "chain": [(i + 1, i) for i in range(199)],
        "star": [(max(i, 77), min(i, 77)) for i in nodes if i != 77],
        "random": [tuple(sorted(rng.sample(nodes, 2), reverse=True)) for _ in range(150)],
        "none": [],
    }[shape]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    expected = reached(links, nodes)
    assert {n: found.get(n, n) for n in nodes} == expected


def check(rows, found):
    fps = [plain.fingerprint(t) for _, t, *_ in rows]
    group = plain.components(fps)
    smallest = {}
    for (doc, *_), g in zip(rows, group):
        smallest[g] = min((x for x in (doc, smallest.get(g)) if x is not None), default=None)
    expected = [(str(doc), f"{fp:016x}", str(smallest[g])) for (doc, *_), fp, g in zip(rows, fps, group)]
    assert sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in found) == sorted(expected)


def near_copies():
    rng = random.Random(6)
    rows = list(plain.messy_rows())
    text = [f"t{rng.randrange(5000)}" for _ in range(400)]
    for i in range(60):
        changed = list(text)
        changed[rng.randrange(400)] = f"changed{i}"
        rows.append((1000 + i, " ".join(changed), "a"))
    return rows + [(2000 + i, " ".join(text).upper(), "b") for i in range(30)]


def test_documents_equal_the_plain_version(spark):
    rows = near_copies()
    docs = spark.createDataFrame([r[:2] for r in rows], SCHEMA).repartition(5)
    check(rows, simhash.near_duplicates(docs).collect())


def test_one_document_of_each_group_stays(spark):
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("fp", F.lit("x")).repartition(5)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    fps = [plain.fingerprint(t) for _, t, _ in rows]
    group = plain.components(fps)
    best = {}
    for (doc, *_), g in zip(rows, group):
        best.setdefault(g, []).append((doc is None, doc or 0))
    expected = Counter(None if min(ids)[0] else min(ids)[1] for ids in best.values())
    assert Counter(r["doc_id"] for r in kept.collect()) == expected


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(docs).count() == 0 and simhash.one_of_each(docs).count() == 0
    assert simhash.near_duplicates(plain.messy_docs(spark)).count() == len(plain.messy_rows())
