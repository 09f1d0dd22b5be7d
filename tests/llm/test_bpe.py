import base64
import hashlib
import random
import time

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dimspark.llm import bpe
from dimspark.llm.queries import op12_bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
with open(PATH, "rb") as file:
    VOCABULARY = bpe.Vocabulary(file.read(), PATTERN)
LIBRARY = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=VOCABULARY.ranks, special_tokens={})
TEXTS = [
    "", " ", "  \n\t x", "Hello world, it's we'll 12345 !!!??  ", "aaaaaaaaaaaaaaaaaaaaaaaa", "é‍👩‍👩‍👧 \x00\x7f￾", "日本語のテキスト。 Ünïcödé",
    "<|endoftext|> <|im_start|>", "\r\n\r\n     x", "x" * 300 + " " * 300 + "-" * 300, "0123456789" * 30, "I'M you'Re don't' 'tis",
]
# Letters that meet in many tokens, white space of several kinds, and what pieces look ahead for.
alphabet = st.sampled_from(list("aaeinst' \n\t1!") + ["th", "ing", "   ", "é", "日", "👩", "'s", "'ll"])
texts = st.lists(alphabet, max_size=40).map("".join)


def ids(text):
    return bpe.encoder(VOCABULARY)([text])[0].tolist()


@pytest.mark.parametrize("text", TEXTS)
def test_tokens_equal_the_library(text):
    assert ids(text) == LIBRARY.encode_ordinary(text)


@settings(max_examples=300, deadline=None)
@given(st.one_of(texts, st.text(max_size=60)))
def test_random_tokens_equal_the_library(text):
    assert ids(text) == LIBRARY.encode_ordinary(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(texts, max_size=8))
def test_texts_together_share_tables(some):
    assert [found.tolist() for found in bpe.encoder(VOCABULARY)(some)] == [LIBRARY.encode_ordinary(t) for t in some]


def test_remembering_few_pieces_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    encode = bpe.encoder(VOCABULARY)
    for text in TEXTS:
        assert [found.tolist() for found in encode([text, "again and again", text])] == [LIBRARY.encode_ordinary(t) for t in (text, "again and again", text)]


def test_every_code_point_is_cut_and_encoded_as_by_the_library():
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 5000):
        text = "".join(f"a{chr(c)}1{chr(c)} {chr(c)}" for c in points[at : at + 5000])
        assert ids(text) == LIBRARY.encode_ordinary(text)


def test_a_pair_is_valid_if_merging_its_bytes_gives_it():
    rng = random.Random(2)
    known = list(VOCABULARY.tokens)
    for _ in range(20_000):
        a, b = rng.choice(known), rng.choice(known[: rng.choice([300, 3000, 50_000])])
        pair = [VOCABULARY.tokens[a], VOCABULARY.tokens[b]]
        assert VOCABULARY.valid(a, b) == (VOCABULARY.merged(b"".join(pair)) == pair)


@settings(max_examples=200, deadline=None)
@given(texts)
def test_the_table_holds_the_last_token_of_every_prefix(text):
    data = text.encode()
    table = bpe.Prefixes(VOCABULARY, data)
    for end in range(1, len(data) + 1):
        assert VOCABULARY.tokens[table.last[end]] == VOCABULARY.merged(data[:end])[-1]


@settings(max_examples=200, deadline=None)
@given(texts, texts, st.integers(0, 60), st.integers(0, 20))
def test_appends_and_replacements_of_bytes(text, more, at, length):
    data = text.encode()
    table = bpe.Prefixes(VOCABULARY, data)
    table.append(more.encode())
    assert table.last == bpe.Prefixes(VOCABULARY, data + more.encode()).last
    whole = data + more.encode()
    start = min(at, len(whole))
    end = min(start + length, len(whole))
    table.replace(start, end, b"xyz")
    assert table.last == bpe.Prefixes(VOCABULARY, whole[:start] + b"xyz" + whole[end:]).last


@settings(max_examples=400, deadline=None)
@given(texts, st.lists(st.tuples(st.integers(0, 60), st.integers(0, 20), texts), max_size=4))
def test_edits_equal_a_fresh_encoding(text, edits):
    encoded = bpe.Encoded(VOCABULARY, text)
    for at, length, new in edits:
        start = min(at, len(encoded.text))
        end = min(start + length, len(encoded.text))
        encoded.edit(start, end, new)
        fresh = bpe.Encoded(VOCABULARY, encoded.text)
        assert (encoded.starts, encoded.stops, encoded.ids()) == (fresh.starts, fresh.stops, fresh.ids())
        assert encoded.ids() == LIBRARY.encode_ordinary(encoded.text)


def test_an_edit_computes_what_is_near_alone():
    text = " ".join(f"word{i}" for i in range(20_000))
    encoded = bpe.Encoded(VOCABULARY, text)
    encoded.computed = 0
    encoded.edit(50_000, 50_003, "changed")
    encoded.append(" and more")
    assert encoded.computed < 100 and encoded.ids() == LIBRARY.encode_ordinary(encoded.text)
    # Within one piece too: behind the edit the table settles after the longest token.
    rng = random.Random(3)
    piece = bpe.Prefixes(VOCABULARY, bytes(rng.choice(b"etaoinshrdlu") for _ in range(50_000)))
    assert piece.replace(20_000, 20_001, b"zz") < 1000
    assert piece.last == bpe.Prefixes(VOCABULARY, piece.data).last


def test_one_long_piece_takes_linear_time():
    seconds = []
    for n in (50_000, 200_000):
        began = time.perf_counter()
        found = ids("ab" * n)
        seconds.append(time.perf_counter() - began)
    assert b"".join(VOCABULARY.tokens[i] for i in found) == b"ab" * n
    assert seconds[1] < 12 * seconds[0]


def test_texts_go_round(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] * 2 + [(None, None, None), (99, "Long text. " * 100_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    for name in ("__row", "__in", "__out", "n_tokens"):
        docs = docs.withColumn(name, F.lit("x"))
    found = bpe.decode(bpe.encode(docs, PATH, PATTERN), PATH).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r["ids"] == LIBRARY.encode_ordinary(r["text"] or "") and bytes(r["decoded"]).decode() == (r["text"] or "") and r["__in"] == "x"


def test_empty_tables_missing_lists_and_unknown_ids(spark):
    assert list(bpe._some(bpe.pa.array(["a", None, "b" * (9 << 20), "c"]))) == [(0, 2), (2, 3), (3, 4)]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode(empty, PATH, PATTERN).collect() == []
    lists = spark.createDataFrame([([72],), (None,), ([],)], "ids array<int>")
    assert sorted(bytes(r["decoded"]) for r in bpe.decode(lists, PATH).collect()) == sorted([VOCABULARY.tokens[72], b"", b""])
    with pytest.raises(Exception, match="KeyError"):
        bpe.decode(spark.createDataFrame([([60_000],)], "ids array<int>"), PATH).collect()


def test_edits_of_a_table(spark):
    edits = [(0, 5, "Howdy"), (100, 200, " end's"), (3, None, "")]
    rows = [(1, "Hello world", edits), (2, None, [(0, 0, "new"), None]), (3, "kept as it is", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, edits array<struct<at:int,until:int,text:string>>")
    found = {r.doc_id: r.ids for r in bpe.encode_edited(docs, PATH, PATTERN).collect()}
    assert found == {1: LIBRARY.encode_ordinary("Howdy world end's"), 2: LIBRARY.encode_ordinary("new"), 3: LIBRARY.encode_ordinary("kept as it is")}


def test_query_equals_the_library(spark):
    sf = "/root/testdata/sf0.001"
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    assert ranks == VOCABULARY.ranks
    texts_of = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    found = op12_bpe(spark, sf).collect()
    assert len(found) == len(texts_of)
    for r in found:
        tokens = LIBRARY.encode_ordinary(texts_of[r.doc_id] or "")
        digest = hashlib.sha256(" ".join(map(str, tokens)).encode()).hexdigest()
        assert (r.n_tokens, r.ids_sha256) == (len(tokens), digest)
        assert r.decoded_sha256 == hashlib.sha256((texts_of[r.doc_id] or "").encode()).hexdigest()
