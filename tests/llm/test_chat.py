import random

import plain  # noqa: F401  keeps the folder's helpers on the path
import pytest

from dimspark.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def conversation(rng, conv, turns):
    rows, role = [], rng.choice(["system", "user"])
    for turn in range(turns):
        n = {"system": 4, "user": 12, "assistant": 60}[role]
        lines = [" ".join(f"w{rng.randrange(50)}" for _ in range(max(1, n + rng.randrange(-3, 4)))) for _ in range(rng.choice([1, 2]))]
        rows.append((conv, turn, role, "\n".join(lines) + ("?" if role == "user" and rng.random() < 0.5 else "")))
        role = {"system": "user", "user": "assistant", "assistant": "user"}[role]
    return rows


@pytest.fixture(scope="module")
def turns():
    rng = random.Random(8)
    rows = [r for c in range(60) for r in conversation(rng, c, rng.choice([1, 2, 5, 8]))]
    return rows + conversation(rng, 1000, 200)  # a third of all rows


@pytest.fixture(scope="module")
def model(spark, turns):
    return chat.fit(chat.sorted_turns(spark.createDataFrame(turns, SCHEMA), "role"))


def best_score(model, texts, roles):
    """The model's score of a path, line by line."""
    flat = [s for t in texts for s in chat.symbols(t or "")]
    path = [r for message in roles for r in message]
    score = model.start[path[0]] + model.emit[path[0], flat[0]]
    for a, b, symbol in zip(path, path[1:], flat[1:]):
        score += max(model.step(symbol)[a, b], chat.NEVER)
    return score


def test_counts_equal_a_plain_count(spark, turns, model):
    import numpy as np

    start, move, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((3, chat.SYMBOLS))
    before = None
    for conv, _, role, text in sorted(turns):
        role = chat.ROLES.index(role)
        for symbol in chat.symbols(text):
            emit[role, symbol] += 1
        if before and before[0] == conv:
            move[before[1], role] += 1
        else:
            start[role] += 1
        before = (conv, role)
    plain_model = chat.model_of(start, move, emit)
    assert all((getattr(model, f) == getattr(plain_model, f)).all() for f in ("start", "move", "emit"))


def test_a_conversation_over_many_slices_has_the_best_path(spark, turns, model):
    ordered = chat.sorted_turns(spark.createDataFrame(turns, SCHEMA).repartition(6))
    slices = ordered.where("conv_id = 1000").select(chat.SLICE).distinct().count()
    assert slices > 1
    found = {(r["conv_id"], r["turn"]): chat.ROLES.index(r["role"]) for r in chat.recover_roles(ordered, model).collect()}
    by_conv = {}
    for conv, turn, _, text in sorted(turns):
        by_conv.setdefault(conv, []).append((turn, text))
    for conv, messages in by_conv.items():
        texts = [t for _, t in messages]
        alone = best_score(model, texts, chat._path(model, texts, None, None))
        split = best_score(model, texts, [[found[conv, turn]] * len(chat.symbols(t)) for turn, t in messages])
        assert split == alone


def test_held_out_accuracy(spark):
    """Fitted on half of the given conversations, decoded on the other half."""
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    model = chat.fit(chat.sorted_turns(table.where("conv_id % 2 = 0"), "role"))
    rest = table.where("conv_id % 2 = 1")
    found = chat.recover_roles(chat.sorted_turns(rest), model).select("conv_id", "turn", "role").distinct()
    right = found.join(rest, ["conv_id", "turn", "role"]).count()
    assert right / rest.count() > 0.9


def test_markers_split_a_transcript(spark, model):
    text = "System: be nice\nUser: hello there?\nmore\n**Assistant**: hi\nthere\n[user] bye\n<|im_start|>assistant ok"
    found = chat.format_chats(spark.createDataFrame([(1, 0, None, text)], SCHEMA), model).orderBy("part").collect()
    assert [(r["role"], r["rendered"].split("\n", 1)[1].removesuffix("\n<|end|>")) for r in found] == [
        ("system", "be nice"),
        ("user", "hello there?\nmore"),
        ("assistant", "hi\nthere"),
        ("user", "bye"),
        ("assistant", "ok"),
    ]


def test_words_that_only_begin_like_markers(model):
    assert chat.marker("Users: many") == (0, 0) and chat.marker("a cat: x") == (0, 0) and chat.marker("") == (0, 0)


def test_nulls_ties_repeats_and_empty_tables(spark, model):
    rows = [(None, None, None, None), (None, 1, "user", "x"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "tool", ""), (2, 0, "user", "")]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", part string")
    found = chat.format_chats(df).collect()
    assert len(found) == len(rows) and all(r["part"] == 0 for r in found)
    assert chat.format_chats(df.limit(0)).count() == 0
    assert chat.format_chats(df.limit(0), model).count() == 0
