import hashlib
import random

import plain
import pytest

from dimspark.llm.decontamination import ADDED, decontaminate

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def found(spark, docs, items, **settings):
    df = decontaminate(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS), **settings)
    return sorted(map(str, (tuple(r) for r in df.select("doc_id", *ADDED).collect())))


def expected(docs, items):
    return sorted(map(str, plain.contamination(docs, items)))


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(2)
    common = [f"c{i}" for i in range(12)]
    items = [(i, " ".join(rng.choice(common) for _ in range(rng.choice([1, 3, 5, 12, 13, 14, 30])))) for i in range(30)]
    items += [(50, items[3][1]), (51, None), (52, ""), (53, "!!! --"), (54, "Ünïcode Wörter ärger 42 " * 4)]
    docs = [(i, " ".join(rng.choice(common) for _ in range(rng.choice([1, 4, 20, 200])))) for i in range(60)]
    docs += [(100 + i, f"{'x ' * (20 * i)} {(t or '').upper()}, {'y ' * i}") for i, t in items[:20]]
    docs += [(200, None), (201, ""), (202, "?!"), (203, items[-1][1].replace(" ", "--")), (203, "c1 c2"), (None, items[7][1])]
    return docs, items


def test_windows_equal_the_plain_version(spark, tables):
    assert found(spark, *tables) == expected(*tables)


@pytest.mark.parametrize("bits_each", [1, 16])
def test_the_join_of_a_large_benchmark_gives_the_same(spark, monkeypatch, tables, bits_each):
    from dimspark.llm import decontamination

    # With few bits most shingles pass the bitmap, and the join alone decides.
    monkeypatch.setattr(decontamination, "BITS_EACH", bits_each)
    monkeypatch.setattr(decontamination, "ROWS_AT_ONCE", 3)
    assert found(spark, *tables, broadcast_words=0) == expected(*tables)


@pytest.mark.parametrize("broadcast_words", [200_000, 0])
def test_long_items_are_cut_into_pieces(spark, monkeypatch, tables, broadcast_words):
    from dimspark.llm import decontamination

    monkeypatch.setattr(decontamination, "PIECE", 4)
    assert found(spark, *tables, broadcast_words=broadcast_words) == expected(*tables)


def test_the_join_reads_documents_as_often_whatever_the_benchmark(spark, monkeypatch):
    """Passes over the documents, counted for a small and for a large benchmark."""
    from dimspark.llm import decontamination

    passes = []
    for name in ("per_text", "_counted", "_surroundings"):
        of = getattr(decontamination, name)
        monkeypatch.setattr(decontamination, name, lambda *args, of=of, name=name: (passes.append(name), of(*args))[1])
    rng, counts = random.Random(4), []
    docs = [(i, " ".join(f"w{rng.randrange(9)}" for _ in range(60))) for i in range(20)]
    for n in (3, 300):
        items = [(i, " ".join(f"w{rng.randrange(9)}" for _ in range(40))) for i in range(n)] + [(n, docs[0][1])]
        passes.clear()
        assert found(spark, docs, items, broadcast_words=50) == expected(docs, items)
        counts.append(len(passes))
    assert counts == [3, 3]


@pytest.mark.parametrize("broadcast_words", [200_000, 0])
def test_a_window_at_the_borders_of_a_text(spark, broadcast_words):
    item = " ".join(f"q{i}" for i in range(13))
    docs = [(1, item), (2, "a " + item), (3, item + " b"), (4, item[3:]), (5, item.replace("q6", "z")), (6, f"{item} {item}")]
    assert found(spark, docs, [(1, item)], broadcast_words=broadcast_words) == expected(docs, [(1, item)])


def test_the_share_of_hit_words_decides(spark):
    item = " ".join(f"q{i}" for i in range(13))
    docs = [(n, item + " w" * (n - 13)) for n in (259, 260, 261)]
    df = decontaminate(spark.createDataFrame(docs, DOCS), spark.createDataFrame([(1, item)], ITEMS))
    assert {r["doc_id"]: r["contaminated"] for r in df.collect()} == {259: True, 260: True, 261: False}


def test_empty_tables_and_clashing_columns(spark):
    docs, none = plain.messy_docs(spark), spark.createDataFrame([], ITEMS)
    clean = decontaminate(docs, none)
    assert clean.where("NOT contaminated AND n_hit = 0 AND _n = 'x'").count() == docs.count()
    assert decontaminate(docs.limit(0), spark.createDataFrame([(1, "a b")], ITEMS)).count() == 0
    many = decontaminate(docs, spark.createDataFrame([(1, "word1"), (2, "word2")], ITEMS), broadcast_words=1)
    assert many.count() == docs.count() and many.where("_n = 'x'").count() == docs.count()


@pytest.mark.parametrize("piece", [4, 20])
def test_one_id_of_many_rows_is_joined_like_others(spark, monkeypatch, piece):
    from dimspark.llm import decontamination

    monkeypatch.setattr(decontamination, "PIECE", piece)
    rng = random.Random(5)
    items = [(7, " ".join(f"w{rng.randrange(40)}" for _ in range(20))) for _ in range(25)]
    items += [items[0]] * 20 + [(i, items[1][1]) for i in range(20)]
    docs = [(i, f"a {text} b") for i, (_, text) in enumerate(items)]
    assert found(spark, docs, items, broadcast_words=50) == found(spark, docs, items) == expected(docs, items)


@pytest.mark.parametrize("broadcast_words", [200_000, 8])
def test_items_without_an_id_contaminate(spark, broadcast_words):
    items = [(None, "a b c d"), (None, "e f g h"), (1, "a b c d"), (2, "i j k l")]
    docs = [(1, "x a b c d y e f g h"), (2, "e f g h"), (3, "i j k l"), (4, "z")]
    digest = {ids: hashlib.sha256(ids.encode()).hexdigest() for ids in ("", "1", "2")}
    rows = [(1, 10, 8, 2, digest["1"], True), (2, 4, 4, 1, digest[""], True), (3, 4, 4, 1, digest["2"], True), (4, 1, 0, 0, digest[""], False)]
    assert found(spark, docs, items, broadcast_words=broadcast_words) == sorted(map(str, rows))
