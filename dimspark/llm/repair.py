"""Conversation structure repair: Wagner-Fischer target alignment (operator 13).

A conversation should read (s?(ua)+)?: perhaps a system turn, then user and assistant
turns in alternation. The cheapest edits that make it so are an alignment of its
turns with the grammar's string of some length, by edits Keep, Rerole, Delete and
Insert. The strings of all lengths end alike, so one table of costs-to-go, by row and
by number of remaining characters, holds the alignment with every length. It is
filled within Ukkonen bands: a cell is left out if the rows and characters that
remain differ by more than an incumbent cost allows; where no length is aligned within
the incumbent it is doubled. Of all lengths with the least cost the audits are traced
and compared, and the ASCII-least stays.

Long conversations are cut into pieces of ``PIECE`` rows. A piece is aligned from each
state at its beginning (nothing written, a system turn, a user turn, an assistant
turn) to each at its end, where inserts belong to the piece of the row they precede.
No audit of a piece is then the beginning of another, so least pieces chain into the
least whole, wherever the cuts are. Rows are sorted across range partitions: a
conversation with a third of all rows lies in many slices, whose pieces are aligned
apart; a second pass chains the pieces of conversations that lie in several slices,
or end one. It streams them, since a hash of a whole text has to be read in order.

Defined results: NULLs count as one space, in the key of the damage too; NULL
conv_ids are one conversation; rows of one turn are ordered by role, then text, NULL
turns come first; repeated rows are adjacent, and all but the first are duplicates;
a role that begins with none of the grammar's letters can only be reroled or deleted;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from dimspark.operators.ordering import POSITION
from dimspark.sources.shared import store

# The costs of edits, what an undeleted truncated row adds, and white space.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
_NOT_SPACE = r"[^\x20\x09-\x0D]"

# Rows, and characters of text, after which a piece ends.
PIECE = 64
PIECE_CHARS = 4 << 20

# Pieces of one conversation that a task holds; one of more is chained in the second pass.
HELD = 64

_NEVER = 1 << 60

# Pairs of neighbouring initials that the grammar allows.
LEGAL = {"su", "ua", "au"}

# States between rows: nothing written, or the initial of the last turn written.
BEGIN = "-"
FULL = {"u": "user", "a": "assistant"}

@dataclass(frozen=True)
class Turn:
    """A row after damage: its role and text, and whether it must go or ends in the middle."""

    role: str
    text: str
    required: bool
    truncated: bool

    @property
    def initial(self) -> str:
        return self.role[:1]

    @property
    def surcharge(self) -> int:
        return TRUNCATED if self.truncated else 0


def _character(end: str, remaining: int) -> str:
    """The first of ``remaining`` alternating characters that end with ``end``."""
    return end if remaining % 2 else ("u" if end == "a" else "a")


def _table(turns: list[Turn], end: str, limit: int) -> list[list[int]]:
    """Costs-to-go by row and remaining characters of strings that end with ``end``, exact up to ``limit``.

    No insert follows the last row. Rows that remain beyond the characters must be
    deleted, characters beyond the rows inserted, so cells off the band cost more than
    the limit.
    """
    n = len(turns)
    widest = n + limit // INSERT + 1
    after = [_NEVER] * (widest + 2)
    after[0] = 0
    table = [after]
    for i in range(n - 1, -1, -1):
        turn, rows = turns[i], n - i
        low, high = max(0, rows - limit // DELETE), rows + limit // INSERT
        here = [_NEVER] * (widest + 2)
        for k in range(low, high + 1):
            best = DELETE + after[k]
            if k:
                best = min(best, INSERT + here[k - 1])
                if not turn.required:
                    keep = 0 if turn.initial == _character(end, k) else REROLE
                    best = min(best, turn.surcharge + keep + after[k - 1])
            here[k] = best
        table.append(here)
        after = here
    table.reverse()
    return table


def _trace(turns: list[Turn], table: list[list[int]], end: str, i: int, k: int) -> str:
    """The ASCII-least audit of least cost for rows from ``i`` and ``k`` characters."""
    audit = []
    while i < len(turns):
        turn, cost = turns[i], table[i][k]
        if cost == DELETE + table[i + 1][k]:
            audit.append("D")
            i += 1
        elif k and cost == INSERT + table[i][k - 1]:
            audit.append("I")
            k -= 1
        else:
            kept = turn.initial == _character(end, k) and cost == turn.surcharge + table[i + 1][k - 1]
            audit.append("K" if kept else "R")
            i, k = i + 1, k - 1
    return "".join(audit)


def _incumbent(turns: list[Turn]) -> int:
    """A cost near one that can be reached: rows out of turn get an insert before them, other roles a new one."""
    cost, last = 0, None
    for turn in turns:
        if turn.required:
            cost += DELETE
            continue
        cost += turn.surcharge
        if turn.initial not in FULL:
            cost += REROLE
            last = "u" if last != "u" else "a"
        else:
            cost += INSERT if turn.initial == last else 0
            last = turn.initial
    return cost + 2 * INSERT


def align(turns: list[Turn]) -> dict[tuple[str, str], tuple[int, str]]:
    """The least cost and audit of a piece by the states before and after it."""
    n = len(turns)
    found: dict[tuple[str, str], tuple[int, str]] = {}

    def offer(before: str, after: str, cost: int, audit: str) -> None:
        if (before, after) not in found or (cost, audit) < found[before, after]:
            found[before, after] = (cost, audit)

    everything = (DELETE * n, "D" * n)
    for state in (BEGIN, "s", "u", "a"):
        offer(state, state, *everything)
    heads = [i for i, t in enumerate(turns) if t.initial == "s" and not t.required]
    for i in heads:
        # A system turn is written only as the first; nothing precedes it but deletes.
        offer(BEGIN, "s", DELETE * (n - 1) + turns[i].surcharge, "D" * i + "K" + "D" * (n - 1 - i))
    for end in "ua":
        limit = _incumbent(turns)
        while True:
            table = _table(turns, end, limit)
            starts = {c: [k for k in range(1, len(table[0]) - 1) if _character(end, k) == c and table[0][k] <= limit] for c in "ua"}
            if all(starts.values()) or not n:
                break
            limit *= 2
        for first, befores in (("u", (BEGIN, "s", "a")), ("a", ("u",))):
            if not starts[first]:
                continue
            least = min(table[0][k] for k in starts[first])
            audits = [_trace(turns, table, end, 0, k) for k in starts[first] if table[0][k] == least]
            for before in befores:
                offer(before, end, least, min(audits))
        options = [
            (DELETE * i + turns[i].surcharge + table[i + 1][k], i, k)
            for i in heads
            for k in range(1, len(table[0]) - 1)
            if _character(end, k) == "u" and table[i + 1][k] < _NEVER
        ]
        least = min((cost for cost, _, _ in options), default=_NEVER)
        for cost, i, k in options:
            if cost == least and cost <= found.get((BEGIN, end), (_NEVER, ""))[0]:
                offer(BEGIN, end, cost, "D" * i + "K" + _trace(turns, table, end, i + 1, k))
    return found


def _lines(state: str, audit: str, roles: list[str], texts: list[str]) -> Iterator[str]:
    """The repaired turns of a piece, as ``role:text``."""
    row = 0
    for edit in audit:
        if edit == "D":
            row += 1
            continue
        if edit == "K":
            state = roles[row][:1]
            yield f"{roles[row]}:{texts[row]}"
        else:
            state = "a" if state == "u" else "u"
            yield f"{FULL[state]}:{texts[row] if edit == 'R' else ''}"
        row += edit != "I"


def _illegal(roles: list[str]) -> int:
    return sum(a[:1] + b[:1] not in LEGAL for a, b in zip(roles, roles[1:], strict=False))


@dataclass(frozen=True)
class Piece:
    """Neighbouring rows of a conversation with their alignments."""

    roles: list[str]
    texts: list[str]
    ends: dict[tuple[str, str], tuple[int, str]]


@dataclass
class _Path:
    """The least alignment so far that ends in a state, as its pieces, last first."""

    cost: int
    audits: tuple | None
    rank: int
    digest: object
    empty: bool = True

    def write(self, lines: Iterable[str]) -> None:
        for line in lines:
            self.digest.update((line if self.empty else "\n" + line).encode())
            self.empty = False


class Chain:
    """The least alignments of all pieces so far, one for each state, with the hash of each one's repaired text.

    No audit of all rows so far begins another, so the order of two is that of their
    first difference: a rank among the few that are left stands for it.
    """

    def __init__(self) -> None:
        self.paths = {BEGIN: _Path(0, None, 0, hashlib.sha256())}
        self.illegal = 0
        self.last: str | None = None

    def add(self, piece: Piece) -> None:
        best: dict[str, tuple[int, int, str, str]] = {}
        for (before, after), (cost, audit) in piece.ends.items():
            if before in self.paths:
                path = self.paths[before]
                option = (path.cost + cost, path.rank, audit, before)
                best[after] = min(best.get(after, option), option)
        order = sorted(best, key=lambda after: best[after][1:3])
        paths = {}
        for after, (cost, _, audit, before) in best.items():
            old = self.paths[before]
            paths[after] = _Path(cost, (old.audits, audit), order.index(after), old.digest.copy(), old.empty)
            paths[after].write(_lines(before, audit, piece.roles, piece.texts))
        self.paths = paths
        first, last = piece.roles[0][:1], piece.roles[-1][:1]
        self.illegal += _illegal(piece.roles) + (self.last is not None and self.last + first not in LEGAL)
        self.last = last

    def end(self) -> tuple[int, int, str, str]:
        """Illegal pairs, cost, audit and digest of the whole; what follows the last row is inserted here."""
        closing = {BEGIN: [], "a": [], "u": ["assistant:"], "s": ["user:", "assistant:"]}
        cost, _, state = min((p.cost + INSERT * len(closing[state]), p.rank, state) for state, p in self.paths.items())
        path, audits = self.paths[state], []
        path.write(closing[state])
        links = path.audits
        while links is not None:
            links, audit = links
            audits.append(audit)
        return self.illegal, cost, "".join(reversed(audits)) + "I" * len(closing[state]), path.digest.hexdigest()


def damaged(turns: DataFrame) -> DataFrame:
    """(``conv_id``, ``turn``, ``role``, ``text``, ``copies``) after the damage; equal rows are one with their number."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    hit = F.crc32(key.cast("binary")) % 20
    rows = turns.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), hit.alias("hit"))
    text = F.expr("CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '') ELSE text END")
    return (
        rows.where("hit <> 0")
        .select("conv_id", "turn", F.expr("IF(hit = 4, 'user', role)").alias("role"), text.alias("text"), F.expr("IF(hit = 3, 2L, 1L)").alias("copies"))
        .groupBy("conv_id", "turn", "role", "text")
        .agg(F.sum("copies").alias("copies"))
    )


def judged(rows: DataFrame) -> DataFrame:
    """``rows`` with ``copies``, and with ``blank``, ``first`` (no earlier turn has its role and text) and ``truncated``.

    A digest stands for role and text, and the earliest turn of each is a minimum
    combined in the tasks; adaptive execution splits a digest that many turns share.
    """
    digest = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256)
    marked = rows.withColumn("digest", digest)
    when = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    earliest = marked.groupBy(F.col("conv_id").alias("of_conv"), F.col("digest").alias("of_digest")).agg(F.min(when).alias("earliest"))
    same = F.col("conv_id").eqNullSafe(F.col("of_conv")) & (F.col("digest") == F.col("of_digest"))
    return marked.join(earliest, same).select(
        *rows.columns,
        (~F.col("text").rlike(_NOT_SPACE)).alias("blank"),
        F.col("turn").eqNullSafe(F.col("earliest.turn")).alias("first"),
        (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*+\z")).alias("truncated"),
    )


def _turns(batches) -> Iterator[tuple[object, int, Turn]]:
    """(conv_id, position, turn) of sorted rows: of equal rows all but the first are duplicates."""
    names = ["conv_id", POSITION, "role", "text", "copies", "blank", "first", "truncated"]
    for batch in batches:
        for conv, position, role, text, copies, blank, first, truncated in zip(*[batch.column(c).to_pylist() for c in names], strict=True):
            yield conv, position, Turn(role, text, blank or not first, truncated)
            for _ in range(copies - 1):
                yield conv, position, Turn(role, text, True, False)


def _pieces(batches) -> Iterator[tuple[object, int, int, Piece]]:
    """(conv_id, position, number, piece) of the rows of a slice."""
    held: list[Turn] = []
    at, place, number, size = None, 0, 0, 0

    def made() -> tuple[object, int, int, Piece]:
        return at, place, number, Piece([t.role for t in held], [t.text for t in held], align(held))

    for conv, position, turn in _turns(batches):
        if held and (conv != at or len(held) == PIECE or size > PIECE_CHARS):
            yield made()
            held, size, number = [], 0, number + 1
        if not held:
            at, place = conv, position
        held.append(turn)
        size += len(turn.text)
    if held:
        yield made()


def _by_conversation(pieces: Iterator[tuple]) -> Iterator[tuple[object, Iterator[tuple]]]:
    # NULL conv_ids are one conversation; equal keys are neighbours.
    for conv, group in itertools.groupby(pieces, key=lambda p: p[0]):
        yield conv, group


_WHOLE = "conv_id {kind}, illegal bigint, cost bigint, audit string, repaired_sha256 string"
_PARTS = (
    _WHOLE + ", position bigint, number bigint, ends array<struct<`before`:string,`after`:string,cost:bigint,audit:string>>, "
    "roles array<string>, texts array<string>"
)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _align_slice(schema: pa.Schema):
    """Function over the sorted rows of a slice.

    A conversation that is neither the first nor the last of the slice, nor long, is
    finished here. Of others the pieces are returned.
    """

    def run(batches):
        def part(conv, position, number, piece):
            ends = [{"before": b, "after": a, "cost": cost, "audit": audit} for (b, a), (cost, audit) in piece.ends.items()]
            return _batch([(conv, None, None, None, None, position, number, ends, piece.roles, piece.texts)], schema)

        done: list[tuple] = []
        waiting: list[tuple] = []  # the conversation before, whole unless it is the last
        for nth, (conv, pieces) in enumerate(_by_conversation(_pieces(batches))):
            if waiting:
                chain = Chain()
                for *_, piece in waiting:
                    chain.add(piece)
                done.append((waiting[0][0], *chain.end(), None, None, None, None, None))
                waiting = []
            if len(done) >= 1000:
                yield _batch(done, schema)
                done = []
            alone = nth > 0
            for piece in pieces:
                if alone and len(waiting) < HELD:
                    waiting.append(piece)
                    continue
                alone = False
                for earlier in waiting:
                    yield part(*earlier)
                waiting = []
                yield part(*piece)
        if done:
            yield _batch(done, schema)
        for piece in waiting:
            yield part(*piece)

    return run


def _chain_pieces(schema: pa.Schema):
    """Function over pieces sorted by conversation and place."""

    def pieces(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ends = {(e["before"], e["after"]): (e["cost"], e["audit"]) for e in row["ends"]}
                yield row["conv_id"], Piece(row["roles"], row["texts"], ends)

    def run(batches):
        for conv, group in _by_conversation(pieces(batches)):
            chain = Chain()
            for _, piece in group:
                chain.add(piece)
            yield _batch([(conv, *chain.end())], schema)

    return run


def repaired(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``illegal``, ``cost``, ``audit`` and ``repaired_sha256`` of the conversations of ``judged`` rows."""
    keys = [F.asc_nulls_first(F.col(c)) for c in ("conv_id", "turn", "role", "text")]
    kind = rows.schema["conv_id"].dataType.simpleString()
    whole, parts = (T.StructType.fromDDL(text.format(kind=kind)) for text in (_WHOLE, _PARTS))
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(POSITION, F.monotonically_increasing_id())
    # Written: the cuts between slices are sampled, and both kinds of rows must come from the same ones.
    aligned = store(ordered.mapInArrow(_align_slice(to_arrow_schema(parts)), parts))
    cut = aligned.where("ends IS NOT NULL").repartition("conv_id").sortWithinPartitions("conv_id", "position", "number")
    chained = cut.select("conv_id", "ends", "roles", "texts").mapInArrow(_chain_pieces(to_arrow_schema(whole)), whole)
    return aligned.where("ends IS NULL").select(*whole.fieldNames()).unionByName(chained)


def repair(turns: DataFrame) -> DataFrame:
    """One row for each original ``conv_id``: its faults, and its cheapest repair.

    Adds ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``,
    ``audit`` and ``repaired_sha256``.
    """
    rows = store(judged(damaged(turns)))
    spread = F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")
    later = F.expr("IF(first, copies - 1, copies)")
    counts = rows.groupBy(F.col("conv_id").alias("of_conv")).agg(
        F.coalesce(spread, F.lit(0)).alias("gaps"),
        F.sum(F.expr("IF(blank, copies, 0L)")).alias("blank"),
        F.sum(F.when(~F.col("blank"), later).otherwise(0)).alias("duplicate"),
        F.sum(F.expr("IF(NOT blank AND first AND truncated, 1L, 0L)")).alias("truncated"),
    )
    fixed = repaired(rows).withColumnRenamed("conv_id", "fixed_conv")
    conversations = turns.select("conv_id").distinct()
    joined = conversations.join(counts, F.col("conv_id").eqNullSafe(F.col("of_conv")), "left").join(
        fixed, F.col("conv_id").eqNullSafe(F.col("fixed_conv")), "left"
    )
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return joined.select(
        "conv_id",
        *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
