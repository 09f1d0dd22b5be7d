"""Byte-level BPE encoding and decoding: prefix dynamic programming (operator 12).

For every prefix of a piece of text the encoding ends with one token, and a token
that ends a prefix is that one if it forms a valid pair with the last token of the
prefix before it: a pair is valid if merging its bytes by rank gives just these two.
So a table holds one token for each byte, and following it back from the end gives
the encoding. Appending bytes goes on from the table's end and changes nothing before.
After an edit the table is computed from the edit on until it agrees with the old one
for as many bytes as the longest token has; from there all is as before.

Tokens that end at a byte come from an Aho-Corasick automaton over the vocabulary, so
a piece takes time in proportion to its length, however long it is. A text is cut by
a pattern first, and pieces are encoded apart.

The vocabulary is a file of base64 tokens and ranks, named by its path. The driver
reads it and sends it to the tasks; its size is that of the file, about a megabyte.

Defined results: a NULL or empty text has no tokens; no string is a special token; an
id outside the vocabulary is an error in decoding, a NULL list of ids no bytes; rows
stay as they are, repeated ones too; a result column replaces an input column of its
name; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import itertools
from array import array
from bisect import bisect_right
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimspark.llm.text import ROW, packed, unpacked

# Pieces, and pairs of tokens, whose answer a task remembers; beyond them it begins anew.
REMEMBERED = 1 << 19
LONGEST_REMEMBERED = 64

# Bytes of text that are encoded together, beside one text of any length.
TOGETHER = 4 << 20

_NEVER = 1 << 60

# Characters after its end that a match of the pattern may have looked at.
AHEAD = 3


def read_tokens(file: bytes) -> dict[int, bytes]:
    """Tokens by rank of a file with a token in base64 and a rank in each line."""
    lines = (line.split() for line in file.splitlines() if line)
    return {int(rank): base64.b64decode(token) for token, rank in lines}


class Vocabulary:
    """Tokens by id, and what encoding needs of them."""

    def __init__(self, file: bytes, pattern: str):
        import ahocorasick
        import regex

        self.tokens = read_tokens(file)
        self.ranks = {token: rank for rank, token in self.tokens.items()}
        self.longest = max(map(len, self.ranks))
        self.pattern = regex.compile(pattern)
        self._ends = ahocorasick.Automaton()
        for token, rank in self.ranks.items():
            self._ends.add_word(token.decode("latin-1"), (len(token), rank))
        self._ends.make_automaton()
        self._pairs: dict[tuple[int, int], bool] = {}
        self._wholes: dict[int, bool] = {}
        self._edges: dict[int, dict[int, list[tuple[bytes, int]]]] = {0: {}, -1: {}}

    def merged(self, data: bytes, least_parts: int = 1) -> list[bytes]:
        """A few bytes after merging the pair of least rank, leftmost first, as long as there is one."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > least_parts:
            least, at = min((self.ranks.get(a + b, _NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if least == _NEVER:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _edge(self, token: int, side: int) -> list[tuple[bytes, int]]:
        """What stands at an edge (0: left, -1: right) of ``token`` while it is merged, and the rank that ends it."""
        edge = self._edges[side].get(token)
        if edge is None:
            data = self.tokens[token]
            if len(data) == 1:
                edge = [(data, _NEVER)]
            else:
                parts = self.merged(data, 2)
                inner = self._edge(self.ranks[parts[side]], side) if len(parts) == 2 else []
                edge = [*inner[:-1], (parts[side], token), (data, _NEVER)]
            self._edges[side][token] = edge
        return edge

    def whole(self, token: int) -> bool:
        """Whether the bytes of ``token`` are encoded as itself."""
        known = self._wholes.get(token)
        if known is None:
            known = self._wholes[token] = len(self.merged(self.tokens[token])) == 1
        return known

    def valid(self, before: int, token: int) -> bool:
        """Whether ``token`` may follow ``before`` (-1: begin a piece).

        It may if, while both are merged rank by rank, what stands left of their
        border never merges with what stands right of it. Of equal ranks the leftmost
        merges first.
        """
        if before < 0:
            return self.whole(token)
        known = self._pairs.get((before, token))
        if known is None:
            if len(self._pairs) >= REMEMBERED:
                self._pairs.clear()
            known = self._pairs[before, token] = self.whole(token) and self._apart(self._edge(before, -1), self._edge(token, 0))
        return known

    def _apart(self, left: list[tuple[bytes, int]], right: list[tuple[bytes, int]]) -> bool:
        i, j, rank_of = 0, 0, self.ranks.get
        while True:
            (a, until_a), (b, until_b) = left[i], right[j]
            across = rank_of(a + b, _NEVER)
            if across < until_a and across <= until_b and across < _NEVER:
                return False
            if until_a == until_b == _NEVER:
                return True
            if until_a <= until_b:
                i += 1
            else:
                j += 1

    def last_tokens(self, data: bytes) -> list[int]:
        """The last token of each prefix of a piece; the empty prefix has -1."""
        last = [-1] + [-2] * len(data)
        pairs, valid = self._pairs, self.valid
        for place, (length, token) in self._ends.iter(data.decode("latin-1")):
            if last[place + 1] == -2:
                before = last[place + 1 - length]
                fits = pairs.get((before, token))
                if fits or (fits is None and valid(before, token)):
                    last[place + 1] = token
        if -2 in last:
            raise ValueError("the vocabulary does not hold every byte")
        return last

    def extend(self, last: list[int], data: bytes) -> None:
        """Complete the table of a short piece whose first prefixes it holds, by looking up every part that ends at a byte."""
        tokens, pairs, valid = self.ranks, self._pairs, self.valid
        for end in range(len(last), len(data) + 1):
            # The last token is the only valid one, so the order is free; short ones are found sooner.
            for begin in range(end - 1, -1, -1):
                token = tokens.get(data[begin:end])
                if token is not None:
                    before = last[begin]
                    fits = pairs.get((before, token))
                    if fits or (fits is None and valid(before, token)):
                        last.append(token)
                        break
            else:
                raise ValueError("the vocabulary does not hold every byte")

    def tokens_of(self, last: list[int] | array) -> list[int]:
        """The encoding that a table of last tokens stands for."""
        found, at, tokens = [], len(last) - 1, self.tokens
        while at:
            token = last[at]
            found.append(token)
            at -= len(tokens[token])
        found.reverse()
        return found

    def ends(self, data: bytes):
        """(index of the last byte, (length, token)) of all tokens in ``data``, in order of their ends."""
        return self._ends.iter(data.decode("latin-1"))


class Prefixes:
    """The last token of each prefix of ``data``; the empty prefix has -1."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data = vocabulary, data
        self.last = array("i", vocabulary.last_tokens(data))

    def append(self, more: bytes) -> None:
        """Go on behind the end; nothing before it changes."""
        done = len(self.data)
        self.data += more
        self._go_on(done, None, 0, 0)

    def replace(self, start: int, end: int, new: bytes) -> int:
        """Put ``new`` in place of the bytes from ``start`` to ``end``; returns how many prefixes were computed."""
        old, shift = self.last, len(new) - (end - start)
        self.data = self.data[:start] + new + self.data[end:]
        self.last = old[: start + 1]
        return self._go_on(start, old, start + len(new), shift)

    def _go_on(self, done: int, old: array | None, unchanged: int, shift: int) -> int:
        """Fill the table from prefix ``done`` + 1; ``old`` holds the values of prefixes from ``unchanged`` on, shifted."""
        vocabulary, last, valid = self.vocabulary, self.last, self.vocabulary.valid
        offset = max(0, done - vocabulary.longest + 1)
        position, token, agreed = done, None, 0

        def settle() -> None:
            if token is None:
                raise ValueError(f"no token ends at byte {position} of a piece")
            last.append(token)

        for place, (length, candidate) in vocabulary.ends(self.data[offset:]):
            end = offset + place + 1
            if end <= done:
                continue
            if end != position:
                if position > done:
                    settle()
                    if old is not None and position >= unchanged:
                        agreed = agreed + 1 if old[position - shift] == last[position] else 0
                        if agreed >= vocabulary.longest:
                            last.extend(old[position - shift + 1 :])
                            return position - done
                position, token = end, None
            if token is None and valid(last[end - length], candidate):
                token = candidate
        if position > done:
            settle()
        if len(last) != len(self.data) + 1:
            raise ValueError("the vocabulary does not hold every byte")
        return position - done

    def tokens(self) -> list[int]:
        return self.vocabulary.tokens_of(self.last)

    def copy(self) -> Prefixes:
        other = Prefixes(self.vocabulary)
        other.data, other.last = self.data, self.last[:]
        return other


class Encoded:
    """A text with the tables of its pieces, to be appended to and edited."""

    def __init__(self, vocabulary: Vocabulary, text: str = ""):
        self.vocabulary, self.text = vocabulary, ""
        self.starts: list[int] = []
        self.stops: list[int] = []
        self.tables: list[Prefixes] = []
        self.computed = 0
        self.edit(0, 0, text)

    def append(self, more: str) -> None:
        self.edit(len(self.text), len(self.text), more)

    def edit(self, start: int, end: int, new: str) -> None:
        """Put ``new`` in place of the characters from ``start`` to ``end``.

        Pieces whose match could not see the edit stay. Behind it, as soon as a piece
        begins where an old one did, all pieces are the old ones.
        """
        keep = bisect_right(self.stops, start - AHEAD)
        begin = self.stops[keep - 1] if keep else 0
        text = self.text[:start] + new + self.text[end:]
        unchanged, shift = start + len(new), len(new) - (end - start)
        old = {at: number for number, at in enumerate(self.starts) if number >= keep}
        starts, stops, tables = self.starts[:keep], self.stops[:keep], self.tables[:keep]
        for match in self.vocabulary.pattern.finditer(text, pos=begin):
            at, stop = match.span()
            if at >= unchanged and at - shift in old:
                rest = old[at - shift]
                starts += [s + shift for s in self.starts[rest:]]
                stops += [s + shift for s in self.stops[rest:]]
                tables += self.tables[rest:]
                break
            starts.append(at)
            stops.append(stop)
            near = old.get(at) if at <= start else None
            tables.append(self._table(match.group().encode(), None if near is None else self.tables[near]))
        self.text, self.starts, self.stops, self.tables = text, starts, stops, tables

    def _table(self, data: bytes, near: Prefixes | None) -> Prefixes:
        """The table of a piece; what it shares with the old piece at its place is taken from there."""
        if near is None:
            self.computed += len(data)
            return Prefixes(self.vocabulary, data)
        same = _shared(near.data, data)
        behind = min(_shared(near.data[::-1], data[::-1]), min(len(near.data), len(data)) - same)
        table = near.copy()
        self.computed += table.replace(same, len(near.data) - behind, data[same : len(data) - behind])
        return table

    def ids(self) -> list[int]:
        return [token for table in self.tables for token in table.tokens()]


def _shared(a: bytes, b: bytes) -> int:
    """The length of the common beginning."""
    n = min(len(a), len(b))
    x, y = np.frombuffer(a, np.uint8, n), np.frombuffer(b, np.uint8, n)
    different = np.flatnonzero(x != y)
    return int(different[0]) if len(different) else n


class Pieces:
    """The tokens of short pieces, remembered while they are few enough.

    New ones are taken in sorted order: a piece goes on from the table of the one
    before, behind the prefix that both share.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        # As the bytes of an array of ids, which are joined into those of a text.
        self.known: dict[str, bytes] = {}

    def learn(self, wanted: set[str]) -> None:
        known = self.known
        if len(known) + len(wanted) > REMEMBERED:
            known.clear()
        last, before = [-1], b""
        extend, tokens_of = self.vocabulary.extend, self.vocabulary.tokens_of
        for piece in sorted(wanted.difference(known)):
            data = piece.encode()
            if len(data) > LONGEST_REMEMBERED:
                known[piece] = array("i", tokens_of(self.vocabulary.last_tokens(data))).tobytes()
                continue
            same = 0
            for x, y in zip(before, data, strict=False):
                if x != y:
                    break
                same += 1
            del last[same + 1 :]
            extend(last, data)
            known[piece] = array("i", tokens_of(last)).tobytes()
            before = data

    def forget_long(self, wanted: set[str]) -> None:
        for piece in wanted:
            if len(piece) > LONGEST_REMEMBERED:
                self.known.pop(piece, None)


def encoder(vocabulary: Vocabulary) -> Callable[[Sequence[str]], list[np.ndarray]]:
    """A function that gives the ids of whole texts, some at a time, and remembers short pieces."""
    pieces, cut = Pieces(vocabulary), vocabulary.pattern.findall

    def encode(texts: Sequence[str]) -> list[np.ndarray]:
        parts = [cut(text) for text in texts]
        wanted = set(itertools.chain.from_iterable(parts))
        pieces.learn(wanted)
        found = [np.frombuffer(b"".join(map(pieces.known.__getitem__, some)), dtype=np.intc) for some in parts]
        pieces.forget_long(wanted)
        return found

    return encode


def _some(values: pa.Array) -> Iterator[tuple[int, int]]:
    """Bounds of slices of a text column of about ``TOGETHER`` bytes, one text at least."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False))
    begin = 0
    while begin < len(values):
        done = int(sizes[begin - 1]) if begin else 0
        end = max(begin + 1, int(np.searchsorted(sizes, done + TOGETHER, side="right")))
        yield begin, end
        begin = end


def _shared_file(spark: SparkSession, path: str) -> Callable[[Callable[[bytes], object]], object]:
    """What a task calls to make something of the vocabulary's file.

    A Python worker keeps what it has made with the broadcast, for its later tasks.
    """
    with open(path, "rb") as file:
        sent = spark.sparkContext.broadcast({"file": file.read()})

    def made(make: Callable[[bytes], object]) -> object:
        kept = sent.value
        if "made" not in kept:
            kept["made"] = make(kept["file"])
        return kept["made"]

    return made


def _run(df: DataFrame, read: Column, run, added: str, name: str, keep: Sequence[str] | None) -> DataFrame:
    """``df`` with the column that ``run`` makes of each row; other columns pass as one struct."""
    kept = list(df.columns if keep is None else keep)
    fed = df.select(packed(df, kept) if kept else F.struct(F.lit(0)).alias(ROW), read.alias("__in"))
    schema = T.StructType([fed.schema[ROW], *T.StructType.fromDDL(f"__out {added}").fields])
    made = fed.mapInArrow(run, schema).withColumnRenamed("__out", name)
    return made.select(*unpacked(kept, [name]))


def _lists(found: Sequence[np.ndarray]) -> pa.Array:
    """Integer lists as one array, without going through a column of objects."""
    offsets = np.cumsum([0, *map(len, found)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found).astype(np.int32, copy=False)))


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", keep: Sequence[str] | None = None) -> DataFrame:
    """``df``, or its columns ``keep``, with the token ids of each whole text."""
    file = _shared_file(df.sparkSession, path)

    def run(batches):
        encode_some = file(lambda data: encoder(Vocabulary(data, pattern)))
        for batch in batches:
            for begin, end in _some(batch.column("__in")):
                part = batch.slice(begin, end - begin)
                found = encode_some([value or "" for value in part.column("__in").to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(ROW), _lists(found)], names=[ROW, "__out"])

    return _run(df, F.col(f"`{text}`"), run, "array<int>", ids, keep)


def decode(df: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded", keep: Sequence[str] | None = None) -> DataFrame:
    """``df``, or its columns ``keep``, with the bytes that each list of ids stands for."""
    file = _shared_file(df.sparkSession, path)

    def run(batches):
        tokens = file(read_tokens)
        for batch in batches:
            lists = batch.column("__in")
            # NULL lists have no length; the rest is cut from one array.
            lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            ends, ids = np.cumsum(lengths), lists.flatten().to_numpy(zero_copy_only=False)
            found = [b"".join(map(tokens.__getitem__, ids[end - n : end].tolist())) for end, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(ROW), pa.array(found, pa.binary())], names=[ROW, "__out"])

    return _run(df, F.col(f"`{ids}`"), run, "binary", decoded, keep)


def encode_edited(df: DataFrame, path: str, pattern: str, text: str = "text", edits: str = "edits", ids: str = "ids") -> DataFrame:
    """``df`` with the token ids of each text after its ``edits``.

    ``edits`` is an array of structs (``at``, ``until``, ``text``), applied one after
    the other; each re-encodes what is near it alone. Places count code points of the
    text as it then is; those beyond its end are its end, and NULL edits none.
    """
    file = _shared_file(df.sparkSession, path)

    def run(batches):
        own = file(lambda data: Vocabulary(data, pattern))
        for batch in batches:
            found = []
            for row in batch.column("__in").to_pylist():
                encoded = Encoded(own, row["text"] or "")
                for edit in row["edits"] or []:
                    if edit is not None:
                        size = len(encoded.text)
                        at = min(max(edit["at"] or 0, 0), size)
                        until = min(max(edit["until"] or 0, at), size)
                        encoded.edit(at, until, edit["text"] or "")
                found.append(np.array(encoded.ids(), dtype=np.intc))
            yield pa.RecordBatch.from_arrays([batch.column(ROW), _lists(found)], names=[ROW, "__out"])

    fed = F.struct(F.col(f"`{text}`").alias("text"), F.col(f"`{edits}`").alias("edits"))
    return _run(df, fed, run, "array<int>", ids, None)
