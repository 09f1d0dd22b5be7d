"""Transcript parsing and canonical turns (operator 9).

The roles of a conversation are recovered from its lines by a hidden Markov model.
A state is a role. A line emits a symbol made of its speaker marker, of whether it
opens a message, of its length and of whether it asks. A line that opens a message,
or has a marker, may change the role by the learned transitions; any other line
goes on. Viterbi's path through all lines of a conversation gives the roles; runs
of lines of one role in a message become one canonical turn, its marker removed.

Messages are sorted by conversation and turn across range partitions, so a
conversation with a third of all rows lies in many slices. The best path through a
piece of a conversation is a max-plus matrix of roles by roles. Each slice reports
the matrices of its first and last piece; the driver chains these few rows, two for
a slice, into the roles at the borders, and each slice then decodes its pieces
between known ends. Scores are whole numbers, so the sum doesn't depend on cuts.

Defined results: a NULL or empty text is one empty line and gives an empty turn;
NULL conv_ids are one conversation; equal (conv_id, turn) pairs and repeated rows
are ordered by text and kept; rows without a known role teach nothing; of equally
good paths through a piece the one with the first role in ``ROLES`` is taken; an
empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimspark.operators.ordering import POSITION, SLICE, order_rows

# The roles, and the speaker markers of each.
ROLES = ["system", "user", "assistant"]
MARKERS = {
    "system": "system instruction instructions context".split(),
    "user": "user human customer client prompt question q".split(),
    "assistant": "assistant ai bot agent model gpt answer a".split(),
}
_ROLE_OF = {word: role for role, words in MARKERS.items() for word in words}
_NAMES = "|".join(sorted(_ROLE_OF, key=len, reverse=True))
_MARKER = re.compile(
    rf"\s*(?:<\|(?:im_start\|>)?\s*(?P<a>{_NAMES})\s*(?:\|>)?|\[\s*(?P<b>{_NAMES})\s*\]:?|#{{1,4}}\s*(?P<c>{_NAMES})\s*:?\s*$"
    rf"|\**(?P<d>{_NAMES})\**\s*:\**)\s*",
    re.IGNORECASE,
)
_LENGTHS = 8
SYMBOLS = 4 * 2 * _LENGTHS * 2
_SCALE = 1 << 20
NEVER = -(1 << 50)


def marker(line: str) -> tuple[int, int]:
    """1 + the number of the role that a line's marker names, or 0; where the line's own text begins."""
    m = _MARKER.match(line)
    if not m:
        return 0, 0
    return 1 + ROLES.index(_ROLE_OF[next(g for g in m.groups() if g).lower()]), m.end()


def symbols(text: str) -> list[int]:
    """The symbol of each line of a message."""
    found = []
    for number, line in enumerate(text.split("\n")):
        named, begin = marker(line)
        length = min(len(line[begin:].split()).bit_length(), _LENGTHS - 1)
        asks = line.rstrip().endswith("?")
        found.append(((named * 2 + (number == 0)) * _LENGTHS + length) * 2 + asks)
    return found


def _marked(symbol: int) -> int:
    return symbol // (4 * _LENGTHS)


def _opens(symbol: int) -> bool:
    return symbol // (2 * _LENGTHS) % 2 == 1


@dataclass(frozen=True)
class Model:
    """Log-probabilities as whole numbers: of first roles, role to role, and role to symbol."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray

    def step(self, symbol: int) -> np.ndarray:
        """Scores from each role to each role over one line."""
        if _opens(symbol) or _marked(symbol):
            return self.move + self.emit[:, symbol]
        stay = np.full_like(self.move, NEVER)
        np.fill_diagonal(stay, self.emit[:, symbol])
        return stay


def _logs(counts: np.ndarray) -> np.ndarray:
    return np.rint(np.log(counts / counts.sum(axis=-1, keepdims=True)) * _SCALE).astype(np.int64)


def model_of(start: np.ndarray, move: np.ndarray, emit: np.ndarray, trust: float = 50.0) -> Model:
    """A model from counts. A marker counts ``trust`` further lines of the role it names."""
    emit = emit + 0.1
    for symbol in range(SYMBOLS):
        if _marked(symbol):
            emit[_marked(symbol) - 1, symbol] += trust
    return Model(_logs(start + 0.1), _logs(move + 0.1), _logs(emit))


def _in_slices(ordered: DataFrame) -> DataFrame:
    """Each slice whole in one partition, in order."""
    return ordered.repartition(SLICE).sortWithinPartitions(POSITION)


def _pieces(batches, *columns: str) -> Iterator[tuple[int, object, list[tuple]]]:
    """(slice, conv_id, rows) of each piece of a conversation within a slice."""
    at, rows = None, []
    for batch in batches:
        values = [batch.column(c).to_pylist() for c in (SLICE, "conv_id", *columns)]
        for part, conv, *row in zip(*values, strict=True):
            if at != (part, conv) and rows:
                yield (*at, rows)
                rows = []
            at = (part, conv)
            rows.append(tuple(row))
    if rows:
        yield (*at, rows)


def _ends(pieces: Iterator[tuple[int, object, list]]) -> Iterator[tuple[int, object, list, bool, bool]]:
    """Pieces, with whether each is the first and the last of its slice."""
    previous, first = None, True
    for piece in pieces:
        if previous is not None:
            yield (*previous, first, piece[0] != previous[0])
            first = piece[0] != previous[0]
        previous = piece
    if previous is not None:
        yield (*previous, first, True)


def sorted_turns(turns: DataFrame, *more: str) -> DataFrame:
    """Conversations in order, written in slices."""
    rows = turns.select("conv_id", "turn", "text", *more)
    return order_rows(rows, [F.col(c) for c in rows.columns])


def fit(ordered: DataFrame) -> Model:
    """The model of (``conv_id``, ``turn``, ``text``, ``role``) rows in order.

    All rows are counted, in the tasks first; what reaches the driver has a fixed
    size but for two rows per slice, which hold the transitions over its borders.
    """
    numbers = {role: i for i, role in enumerate(ROLES)}

    def count(batches):
        start, move = np.zeros(3, dtype=np.int64), np.zeros((3, 3), dtype=np.int64)
        emit = np.zeros((3, SYMBOLS), dtype=np.int64)
        borders = []
        for part, conv, rows, first, last in _ends(_pieces(batches, "text", "role")):
            roles = [numbers.get(role) for _, role in rows]
            for (text, _), role in zip(rows, roles, strict=True):
                if role is not None:
                    np.add.at(emit[role], symbols(text or ""), 1)
            for a, b in zip(roles, roles[1:], strict=False):
                if a is not None and b is not None:
                    move[a, b] += 1
            if first:
                borders.append((part, 0, conv, roles[0]))
            elif roles[0] is not None:
                start[roles[0]] += 1
            if last:
                borders.append((part, 1, conv, roles[-1]))
        cells = [("start", 0, j, int(n)) for j, n in enumerate(start)]
        cells += [("move", i, j, int(move[i, j])) for i in range(3) for j in range(3)]
        cells += [("emit", i, j, int(emit[i, j])) for i in range(3) for j in np.flatnonzero(emit[i]).tolist()]
        cells = [(*cell, None, None) for cell in cells if cell[3]]
        cells += [("border", part, side, None, None if conv is None else str(conv), role) for part, side, conv, role in borders]
        columns = list(zip(*cells, strict=True)) or [()] * 6
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
        names = ["kind", "i", "j", "n", "conv", "role"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    schema = "kind string, i bigint, j bigint, n bigint, conv string, role bigint"
    counted = _in_slices(ordered).mapInArrow(count, schema)
    start, move, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((3, SYMBOLS))
    borders = []
    for r in counted.groupBy("kind", "i", "j", "conv", "role").agg(F.sum("n").alias("n")).collect():
        if r["kind"] == "border":
            borders.append((r["i"], r["j"], r["conv"], r["role"]))
        elif r["kind"] == "start":
            start[r["j"]] += r["n"]
        else:
            (move if r["kind"] == "move" else emit)[r["i"], r["j"]] += r["n"]
    before = None
    for _, side, conv, role in sorted(borders, key=lambda b: b[:2]):
        if side == 0 and role is not None:
            if before is None or before[0] != conv:
                start[role] += 1
            elif before[1] is not None:
                move[before[1], role] += 1
        before = (conv, role)
    return model_of(start, move, emit)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The max-plus product: the best score over the role between."""
    return np.maximum((a[:, :, None] + b[None, :, :]).max(axis=1), NEVER)


def _piece_matrix(model: Model, texts: list[str | None], begins: bool) -> np.ndarray:
    """Best scores from the role before a piece to its last role; row 0 only if the conversation begins here."""
    total = None
    for text in texts:
        for symbol in symbols(text or ""):
            if total is None:
                total = np.tile(model.start + model.emit[:, symbol], (3, 1)) if begins else model.step(symbol)
            else:
                total = _times(total, model.step(symbol))
    return total


def _path(model: Model, texts: list[str | None], before: int | None, last: int | None) -> list[list[int]]:
    """The roles of the lines of each text on the best path between two known ends; None is open."""
    steps = [symbols(text or "") for text in texts]
    flat = [symbol for message in steps for symbol in message]
    score = model.start + model.emit[:, flat[0]] if before is None else model.step(flat[0])[before]
    came = []
    for symbol in flat[1:]:
        through = score[:, None] + model.step(symbol)
        came.append(through.argmax(axis=0))
        score = np.maximum(through.max(axis=0), NEVER)
    roles = [int(score.argmax()) if last is None else last]
    for back in reversed(came):
        roles.append(int(back[roles[-1]]))
    roles.reverse()
    found, at = [], 0
    for message in steps:
        found.append(roles[at : at + len(message)])
        at += len(message)
    return found


def _border_roles(rows: list) -> tuple[dict[int, int], dict[int, int]]:
    """For slices that begin inside a conversation the role before, for those that end inside one the last role.

    ``rows``: (slice, conv, continues the slice's only piece, matrices) of first and last pieces.
    """
    before: dict[int, int] = {}
    last: dict[int, int] = {}
    ordered = sorted(rows, key=lambda r: (r["slice"], r["side"]))
    chain: list[tuple[int, np.ndarray]] = []

    def close() -> None:
        if len(chain) > 1:
            scores, came = [chain[0][1][0]], []
            for _, matrix in chain[1:]:
                through = scores[-1][:, None] + matrix
                came.append(through.argmax(axis=0))
                scores.append(through.max(axis=0))
            role = int(scores[-1].argmax())
            for k in range(len(chain) - 1, 0, -1):
                last[chain[k][0]] = role
                role = int(came[k - 1][role])
                before[chain[k][0]] = role
            last[chain[0][0]] = role
        chain.clear()

    conv = object()
    for r in ordered:
        begins = np.array(r["begins"], dtype=np.int64).reshape(3, 3)
        goes_on = np.array(r["goes_on"], dtype=np.int64).reshape(3, 3)
        if r["side"] == 0 and chain and r["conv"] == conv:
            chain.append((r["slice"], goes_on))
        elif r["side"] == 0 or not r["only"]:
            close()
            chain.append((r["slice"], begins))
        conv = r["conv"]
        if r["side"] == 0 and not r["only"]:
            close()
    close()
    return before, last


def recover_roles(ordered: DataFrame, model: Model, keep: tuple[str, ...] = ()) -> DataFrame:
    """``conv_id``, ``turn``, ``part``, ``role`` and ``rendered`` turns of sorted messages.

    ``part`` numbers the turns within a message. ``keep`` names further columns.
    """
    spark = ordered.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def report(batches):
        model, rows = shared.value, []
        for part, conv, texts, first, last in _ends(_pieces(batches, "text")):
            if first or last:
                texts = [t for (t,) in texts]
                both = [_piece_matrix(model, texts, begins).ravel().tolist() for begins in (True, False)]
                conv = None if conv is None else str(conv)
                rows += [(part, 0, conv, first and last, *both)] if first else []
                rows += [(part, 1, conv, False, *both)] if last and not first else []
        columns = list(zip(*rows, strict=True)) or [()] * 6
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        names = ["slice", "side", "conv", "only", "begins", "goes_on"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    schema = "slice bigint, side bigint, conv string, only boolean, begins array<bigint>, goes_on array<bigint>"
    narrow = ordered.select(SLICE, POSITION, "conv_id", "text")
    borders = spark.sparkContext.broadcast(_border_roles(_in_slices(narrow).mapInArrow(report, schema).collect()))
    columns = ["conv_id", "turn", *keep]
    kinds = ", ".join(f"`{c}` {ordered.schema[c].dataType.simpleString()}" for c in columns)

    def decode(batches):
        model, (before, last) = shared.value, borders.value
        types, rows = None, []
        names = [*columns, "part", "role", "rendered"]

        def flush():
            values = list(zip(*rows, strict=True)) or [()] * len(names)
            kinds = [*types, pa.int64(), pa.string(), pa.string()]
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names=names)

        def watched(batches):
            nonlocal types
            for batch in batches:
                types = [batch.schema.field(c).type for c in columns]
                yield batch

        for part, conv, messages, first, final in _ends(_pieces(watched(batches), "text", *columns[1:])):
            texts = [m[0] for m in messages]
            known = (before.get(part) if first else None, last.get(part) if final else None)
            for (text, *rest), roles in zip(messages, _path(model, texts, *known), strict=True):
                for number, (role, content) in enumerate(_turns(text or "", roles)):
                    rows.append((conv, *rest, number, ROLES[role], f"<|{ROLES[role]}|>\n{content}\n<|end|>"))
                if len(rows) >= 5000:
                    yield flush()
        if rows:
            yield flush()

    return _in_slices(ordered.select(SLICE, POSITION, "text", *columns)).mapInArrow(
        decode, f"{kinds}, part bigint, role string, rendered string"
    )


def _turns(text: str, roles: list[int]) -> list[tuple[int, str]]:
    """Runs of lines of one role, without their markers. A marker also begins a turn."""
    turns: list[tuple[int, list[str]]] = []
    for line, role in zip(text.split("\n"), roles, strict=True):
        named, begin = marker(line)
        if not turns or turns[-1][0] != role or named:
            turns.append((role, []))
        turns[-1][1].append(line[begin:])
    return [(role, "\n".join(lines).strip()) for role, lines in turns]


def format_chats(turns: DataFrame, model: Model | None = None) -> DataFrame:
    """Canonical turns of ``conv_id``, ``turn``, ``text`` messages.

    Without a model one is fitted on the rows that have a role; decoding doesn't
    look at roles.
    """
    if model is None:
        ordered = sorted_turns(turns, "role")
        model = fit(ordered)
    else:
        ordered = sorted_turns(turns)
    return recover_roles(ordered, model)
