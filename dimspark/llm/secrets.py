"""Secret scans with multipart credential linking (operator 7).

Base kinds are found by their own form alone: ``assign``, ``access`` and ``hex``.
Besides, weak candidates for the parts of a credential are collected: identifiers
(``id``), secrets (``secret``) and endpoints (``endpoint``) whose form alone proves
nothing. Each identifier, weak or an ``access`` match, opens a scope: the lines
within ``reach_lines`` of its own, however long they are, and the whole block of
settings, sections and keys it lies in. The
parts are interval-joined with the scopes, by bisection over their starts. A weak
identifier or secret is reported only if a scope holds both an identifier and a
secret, not overlapping, of which base matches may be one; an endpoint only if its
scope holds both.

All parts of a document are in its own row, so nothing is shuffled, and the work
for a document follows its length: each part looks at its neighbours within the
reach, and only asks whether a complement exists.

Defined results: a NULL or empty text has no matches; repeated rows get a row
each; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimspark.llm.text import ROW, packed, per_text, unpacked

KINDS = ["assign", "access", "hex", "id", "secret", "endpoint"]
BASE = KINDS[:3]

# What any match contains, the form, the group whose length counts, and its smallest length. Runs of fewer than
# 16 hex digits would be dropped, so they are not matched at all.
_BASE = {
    "assign": (
        ("=", ":"),
        re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
        1,
        12,
    ),
    "access": (("AKIA",), re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    "hex": (("",), re.compile(r"[0-9a-f]{16,}+"), 0, 16),
}
_PREFIXED = re.compile(r"\bA(?:KIA|SIA|IDA|ROA)[A-Z0-9]{8,}")
_ID = re.compile(
    r"""(?ai:access[_-]?key[_-]?id|access[_-]?key|client[_-]?id|account[_-]?id|key[_-]?id|user(?:_?name)?|login)"""
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@+-]{4,})|\bA(?:KIA|SIA|IDA|ROA)[A-Z0-9]{8,}"""
)
_SHORT = re.compile(
    r"""(?ai:password|passwd|pwd|secret(?:[_-]?(?:access[_-]?)?key)?|token|api[_-]?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]{6,})"""
)
# A value may follow a sign of equality; its own end can be padded with one.
_RANDOM = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}(?![A-Za-z0-9+/=_-])")
# A line of a credential file: settings, the head of a section, a bracket, a line of a key, or a comment.
_SET = r"""["']?[A-Za-z_][A-Za-z0-9_.-]*+["']?[\x20\t]*+[:=][\x20\t]*+(?:"[^"]*+"|'[^']*+'|[^\s;,&"']*+)"""
_SETTING = re.compile(
    rf"""\s*+(?:(?:export\s++|-\s++)?[{{\[]?\s*+{_SET}(?:[;,&]\s*+{_SET})*+[;,]?\s*+[}}\]]?,?|\[[^\]]*+\]|[{{}}\[\]],?|[A-Za-z0-9+/_-]{{16,}}+={{0,2}}|[#;].*)\s*"""
)

_ENDPOINT = re.compile(r"(?ai:https?|ftps?|s3|jdbc:[a-z]+|amqps?|mongodb|postgres(?:ql)?|redis)://[^\s\"'<>]+")

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each base kind; matches that are too short are dropped."""
    found = []
    for kind, (needs, pattern, group, least) in _BASE.items():
        if not any(part in text for part in needs):
            continue
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                found.append((m.start(), m.end(), kind))
    return found


def _mixed(value: str) -> bool:
    """Looks drawn at random: upper and lower case letters and digits, few repeats."""
    kinds = (str.isdigit, str.islower, str.isupper)
    return all(any(map(kind, value)) for kind in kinds) and 2 * len(set(value)) >= min(len(value), 32)


def weak_ids(text: str) -> list[Span]:
    if "=" not in text and ":" not in text and not _PREFIXED.search(text):
        return []
    return [(m.start(), m.end(), "id") for m in _ID.finditer(text)]


def weak_secrets(text: str) -> list[Span]:
    found = [(m.start(), m.end(), "secret") for m in _SHORT.finditer(text)]
    drawn = [m for m in _RANDOM.finditer(text) if _mixed(m.group())]
    # A value right behind the sign of a known label is part of the label's span.
    labelled = sorted(found + weak_ids(text)) if drawn else []
    starts = [s[0] for s in labelled]

    def has_label(m: re.Match) -> bool:
        at = bisect_left(starts, m.start()) - 1
        return text[m.start() - 1 : m.start()] == "=" and at >= 0 and labelled[at][1] >= m.end()

    return found + [(m.start(), m.end(), "secret") for m in drawn if not has_label(m)]


def endpoints(text: str) -> list[Span]:
    return [(m.start(), m.end(), "endpoint") for m in _ENDPOINT.finditer(text)] if "://" in text else []


def credential_blocks(text: str) -> list[tuple[int, int]]:
    """(start, end) of runs of settings and key lines; single blank lines may lie between."""
    found: list[tuple[int, int]] = []
    start, end, at, blank, key = None, 0, 0, 0, False
    for line in text.split("\n"):
        key = key or line.lstrip().startswith("-----BEGIN ")
        blank = 0 if line.strip() or key else blank + 1
        if key or (not blank and _SETTING.fullmatch(line)):
            start, end = at if start is None else start, at + len(line)
        elif start is not None and blank != 1:
            found.append((start, end))
            start = None
        key = key and not line.lstrip().startswith("-----END ")
        at += len(line) + 1
    return found + ([(start, end)] if start is not None else [])


class _Parts:
    """Spans of one role by start, for asking whether any lies in an interval, apart from a given span."""

    def __init__(self, spans: list[Span]):
        self.spans = sorted(spans)
        self.starts = [s[0] for s in self.spans]

    def within(self, low: int, high: int, apart: Span) -> bool:
        before = range(bisect_left(self.starts, low), bisect_left(self.starts, apart[0]))
        after = range(bisect_left(self.starts, apart[1]), bisect_left(self.starts, high))
        return any(self.spans[i][1] <= apart[0] for i in before) or any(self.spans[i][1] <= high for i in after)


def linked_spans(text: str, base: list[Span], reach_lines: int = 5) -> list[Span]:
    """The weak spans whose complements are in scope."""
    taken = {(s, e) for s, e, _ in base}
    identifiers = [s for s in weak_ids(text) if s[:2] not in taken]
    ids = _Parts(identifiers + [s for s in base if s[2] == "access"])
    if not ids.spans:
        return []
    secrets = [s for s in weak_secrets(text) if s[:2] not in taken]
    keys = _Parts(secrets + [s for s in base if s[2] in ("assign", "hex")])
    if not keys.spans:
        return []
    breaks = [m.start() for m in re.finditer("\n", text)]

    blocks = credential_blocks(text)
    heads = [start for start, _ in blocks]

    def near(span: Span) -> tuple[int, int]:
        first = bisect_left(breaks, span[0]) - 1 - reach_lines
        last = bisect_left(breaks, span[1]) + reach_lines
        return breaks[first] + 1 if first >= 0 else 0, breaks[last] if last < len(breaks) else len(text)

    def has(parts: _Parts, span: Span) -> bool:
        at = bisect_left(heads, span[0] + 1) - 1
        block = at >= 0 and span[1] <= blocks[at][1]
        return parts.within(*near(span), span) or (block and parts.within(*blocks[at], span))

    reported = [s for s in identifiers if has(keys, s)]
    reported += [s for s in secrets if has(ids, s)]
    return reported + [s for s in endpoints(text) if has(ids, s) and has(keys, s)]


def joined(spans: list[Span]) -> str:
    """kind:start:end by start, then kind as listed."""
    ordered = sorted(set(spans), key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in ordered)


FIELDS = [("n_assign", "bigint"), ("n_access", "bigint"), ("n_hex", "bigint"), ("base", "string"), ("spans", "string")]
ADDED = ["n_assign", "n_access", "n_hex", "base_sha256", "spans"]


def scan(text: str, reach_lines: int = 5) -> tuple:
    base = base_spans(text)
    counts = [sum(kind == b for *_, b in base) for kind in BASE]
    return (*counts, joined(base), joined([*base, *linked_spans(text, base, reach_lines)]))


def scan_secrets(docs: DataFrame, reach_lines: int = 5, keep: Sequence[str] | None = None) -> DataFrame:
    """``docs`` with the numbers of base matches, a digest of them, and all spans, base and linked.

    ``keep`` names the columns to carry, all if it is None; one named like an added
    column is replaced.
    """
    rows = docs.select(packed(docs, keep), "text")
    found = per_text(rows, "text", FIELDS, lambda: lambda text: scan(text, reach_lines))
    digest: Column = F.sha2("base", 256)
    return found.withColumn("base_sha256", digest).select(ROW, *ADDED).select(*unpacked(keep or docs.columns, ADDED))
