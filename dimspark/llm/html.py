"""Main text of web pages, with a host-wide suffix array against boilerplate (operator 10).

A page is read into blocks of text, each in a zone: ``main`` inside an article or
main element, ``cut`` inside elements that are menus, headers, footers, sidebars,
notices, adverts, forms or comments by their tag, role or class, and ``open``
elsewhere. Both main and open blocks are judged by the repeats of the page's host, and
the zone is a weight. A main block goes only if, whole and as a main block, it is in
``MAIN_SHARE`` of the distinct pages of the host and in ``LEAST_PAGES`` or more. A page
returns the main blocks that stay; if its open text without boilerplate is longer than
these (a teaser or a title is marked as main, or nothing is), it returns the open text
too, in the order of the page.

Boilerplate in open text may begin and end anywhere. The
streams of cut and open tokens of all pages of a host are taken as one sequence of
suffixes. Sorted by their first ``run`` tokens, the suffixes with equal beginnings
are neighbours: these classes are the intervals of the host's suffix array whose
common prefix is ``run`` tokens or longer, and longer repeats are overlapping
classes. A class is repeated if at least ``LEAST_PAGES`` distinct pages and
``OPEN_SHARE`` of all distinct pages of the host hold it. Repeated classes that follow
each other make a maximal repeat; its tokens are removed if it is ``LONG`` tokens or
longer or fills whole blocks, the runs between repeats stay.

Copies and near copies of a page count as one page, so a story in many versions
doesn't erase itself. Near copies share most of a sketch of the runs of their bodies
(what isn't cut); candidates meet in bands of it, each is compared with one leader of
its band, and links are followed to their ends.

The array is sorted by Spark as one aggregation over hosts and beginnings, so a host
with a third of all pages is spread like many small ones, and a beginning that all
its pages share is reduced in the tasks that read it.

Defined results: a NULL or empty html has an empty text; a url without a
host shares nothing with others; elements that are never closed end with the page; repeated rows get a row
each; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from zlib import crc32

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimspark.llm.components import components
from dimspark.llm.text import per_text
from dimspark.llm.urls import with_host_and_path
from dimspark.sources.shared import store

RUN = 6
LONG = 8  # tokens of a repeat that doesn't fill whole blocks
LEAST_PAGES = 3
OPEN_SHARE = 0.2
MAIN_SHARE = 0.5

# A sketch has as many values as there are multipliers, in bands of ``BAND``.
BAND, ALIKE = 4, 16
_MULTIPLIERS = [np.uint64(xxhash.xxh64_intdigest(str(i).encode()) | 1) for i in range(24)]
_PRIME = np.uint64(0x9E3779B97F4A7C15)

# Fixed values of HTML: elements by what they do to the text.
VOID = "area base br col embed hr img input link meta source track wbr".split()
SILENT = "script style noscript template head title svg math iframe object canvas textarea select audio video".split()
RAW = "script style textarea title".split()
BLOCKS = (
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
    "summary table tbody td tfoot th thead tr ul"
).split()
CUT = "nav footer aside menu button dialog search".split()
CUT_ROLES = "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split()
CUT_NAMES = (
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent "
    "cookie cookies disqus footer header masthead menu modal nav navbar navigation newsletter notice notices pager "
    "pagination popup promo promoted related replies respond share sharing sidebar social sponsor sponsored subscribe "
    "toolbar widget"
).split()

# Words that say where or how large a part is; with a word from CUT_NAMES they name one, as in "site-footer".
PLACE_NAMES = (
    "area bar block bottom box button buttons column container content desktop fixed form global group inner item items "
    "layout left link links list main mobile outer page panel posts primary region right row secondary section site slot "
    "sticky top unit wrap wrapper"
).split()

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>"
    r"|<(?P<close>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*+)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"(?i)(?<![^\s\"'/])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/\"']|$)")
_SPACE = re.compile(r"\s+")
_CLOSES_P = frozenset(BLOCKS) - {"body", "html", "legend", "li", "optgroup", "option", "tbody", "td", "tfoot", "th", "thead", "tr", "dd", "dt"}
_SIBLINGS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "p": {"p"},
}
_VOID, _SILENT, _RAW, _BLOCKS, _CUT = map(frozenset, (VOID, SILENT, RAW, BLOCKS, CUT))
_ROLES, _NAMES, _PLACES = frozenset(CUT_ROLES), frozenset(CUT_NAMES), frozenset(PLACE_NAMES)
_HEADERS = frozenset("banner header masthead".split())
_COMMENTS = frozenset("comment comments commentlist replies respond".split())


def _named(value: str, names: frozenset[str]) -> bool:
    """Whether a class or an id is one of ``names``, or made of one and words of place alone: not "share-price"."""
    for whole in value.split():
        parts = [part for part in re.split(r"[^a-z0-9]+", whole) if part]
        if not names.isdisjoint(parts) and all(part in names or part in _PLACES for part in parts):
            return True
    return False


def _cuts(tag: str, attributes: str, in_main: bool) -> str | None:
    """``cut`` for elements that are no text by what they are; ``named`` for those that only seem so by a name, and forms."""
    if tag == "form":
        kind = "named"
    else:
        kind = "cut" if tag in _CUT or (tag == "header" and not in_main) else None
    if not attributes or tag in ("main", "body", "html"):
        return kind
    # Within the main part a header by name is its own, as a header element is.
    names = _COMMENTS if tag == "article" else _NAMES - _HEADERS if in_main else _NAMES
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return "cut"
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return "cut"
        if name == "role" and value in _ROLES:
            return "cut"
        if name in ("class", "id"):
            if _named(value, names & _COMMENTS):
                return "cut"
            if _named(value, names):
                kind = kind or "named"
    return kind


class _Zone:
    """An element that sets a zone, and the words in it: of main elements, and all."""

    __slots__ = ("kind", "main", "words")

    def __init__(self, kind: str):
        self.kind, self.main, self.words = kind, 0, 0


def blocks(page: str) -> list[tuple[str, str]]:
    """(zone, text) of each block of a page, in order; white space is one space, empty blocks are left out.

    An element that is cut by its name alone, or is a form, stays if it holds more
    than half of the words in main elements, or of all words where no main element
    has any: then it is a frame around the page.
    """
    found: list[tuple[tuple[_Zone, ...], str]] = []
    text: list[str] = []
    stack: list[tuple[str, _Zone | None]] = []  # open elements with the zone they set
    opened: Counter[str] = Counter()
    bases: list[int] = []  # places in the stack of elements that aren't inline, or set a zone
    zones: tuple[_Zone, ...] = ()
    silent = 0

    def flush() -> None:
        joined = _SPACE.sub(" ", html.unescape("".join(text))).strip()
        text.clear()
        if joined:
            found.append((zones, joined))

    def leave() -> None:
        nonlocal silent, zones
        tag, zone = stack.pop()
        opened[tag] -= 1
        if bases and bases[-1] == len(stack):
            bases.pop()
        if tag in _BLOCKS or zone:
            flush()
        if zone:
            zones = zones[:-1]
        silent -= tag in _SILENT

    at = 0
    while at < len(page):
        m = _TOKEN.search(page, at)
        end = m.start() if m else len(page)
        if not silent and end > at:
            text.append(page[at:end])
        if not m:
            break
        at = m.end()
        if not m["tag"]:
            continue
        tag = m["tag"].lower()
        if m["close"]:
            if opened[tag]:
                while stack[-1][0] != tag:
                    leave()
                leave()
            elif tag in _BLOCKS and not silent:
                flush()
            continue
        if tag in _VOID:
            if not silent:
                if tag == "hr":
                    flush()
                else:
                    text.append(" " if tag == "br" else "")
            continue
        if m["attributes"].endswith("/") and tag in ("svg", "math", "path"):
            continue
        if tag in _RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>|\Z", re.IGNORECASE).search(page, at)
            at = close.end()
            continue
        ends = _SIBLINGS.get(tag) or ({"p"} if tag in _CLOSES_P else ())
        # The nearest element that isn't inline, if it ends here; inline elements left open go with it.
        while ends and bases and not silent and stack[bases[-1]][0] in ends:
            for _ in range(len(stack) - bases[-1]):
                leave()
        if tag in _BLOCKS and not silent:
            flush()
        kind = None
        if len(zones) < DEEPEST and (not zones or zones[-1].kind != "cut"):
            kind = _cuts(tag, m["attributes"], any(zone.kind == "main" for zone in zones)) or ("main" if tag in ("article", "main") else None)
        zone = _Zone(kind) if kind else None
        if zone and tag not in _BLOCKS:
            flush()
        if zone or tag not in _INLINE:
            bases.append(len(stack))
        stack.append((tag, zone))
        opened[tag] += 1
        if zone:
            zones = (*zones, zone)
        silent += tag in _SILENT
    while stack:
        leave()
    flush()
    return _zoned(found)


# Zones within zones that are told apart; what lies deeper belongs to the last.
DEEPEST = 64


def _zoned(found: list[tuple[tuple[_Zone, ...], str]]) -> list[tuple[str, str]]:
    """The zone of each block, when all words have been seen."""
    all_words = all_main = 0
    for zones, text in found:
        words = text.count(" ") + 1
        kinds = {zone.kind for zone in zones}
        main = words if "main" in kinds and "cut" not in kinds else 0
        all_words, all_main = all_words + words, all_main + main
        for zone in zones:
            zone.words += words
            zone.main += main

    def cuts(zone: _Zone) -> bool:
        frame = 2 * zone.main > all_main if all_main else 2 * zone.words > all_words
        return zone.kind == "cut" or (zone.kind == "named" and not frame)

    return [("cut" if any(map(cuts, zones)) else "main" if any(z.kind == "main" for z in zones) else "open", text) for zones, text in found]


_INLINE = frozenset("a abbr b big cite code em font i mark q s small span strike strong sub sup tt u".split())


def main_text(page: str) -> str | None:
    """The main blocks, joined by line ends; None if the page has no main element with text."""
    parts = [text for zone, text in blocks(page) if zone == "main"]
    return "\n".join(parts) if parts else None


def _outer(found: list[tuple[str, str]]) -> tuple[list[str], list[int]]:
    """The cut and open tokens, and the block of each (-1 if cut)."""
    tokens, places = [], []
    for number, (zone, text) in enumerate(found):
        if zone != "main":
            words = text.split(" ")
            tokens += words
            places += [number if zone == "open" else -1] * len(words)
    return tokens, places


def _digest(tokens: list[str]) -> int:
    return xxhash.xxh64_intdigest("\x00".join(tokens).encode()) >> 1


def _streams(page: str) -> tuple[bool, list[str], list[int], int]:
    """Whether there is main text; the cut and open tokens, the block of each (-1 if cut), and a hash of them."""
    found = blocks(page)
    tokens, places = _outer(found)
    return any(zone == "main" for zone, _ in found), tokens, places, _digest(tokens)


def _sketch(tokens: list[str]) -> list[int]:
    """The smallest hash of all runs, for each multiplier; pages agree in about the share of the runs they share."""
    if not tokens:
        return []
    hashes = np.fromiter((crc32(t.encode()) for t in tokens), dtype=np.uint64, count=len(tokens))
    n = max(len(tokens) - RUN + 1, 1)
    runs = np.zeros(n, dtype=np.uint64)
    for i in range(min(RUN, len(tokens))):
        runs = (runs ^ hashes[i : i + n]) * _PRIME
        runs ^= runs >> np.uint64(29)
    return [int(((runs * m) >> np.uint64(33)).min()) for m in _MULTIPLIERS]


def _read(page: str) -> tuple[list[str], list[int], list[int], list[str], int, list[int]]:
    """The outer tokens and their blocks, the main blocks and their texts, and a hash and a sketch of the body."""
    found = blocks(page)
    main = [(number, text) for number, (zone, text) in enumerate(found) if zone == "main"]
    body = [token for zone, text in found if zone != "cut" for token in text.split(" ")]
    return *_outer(found), [n for n, _ in main], [text for _, text in main], _digest(body), _sketch(body)


def _covered(places: list[int], starts: list[int], run: int) -> set[int]:
    """The places of tokens in maximal repeats that are long or fill whole blocks."""
    covered, ordered, first = set(), sorted(starts), 0
    for i in range(1, len(ordered) + 1):
        if i < len(ordered) and ordered[i] == ordered[i - 1] + 1:
            continue
        low, high = ordered[first], ordered[i - 1] + run
        whole = (low == 0 or places[low - 1] != places[low]) and (high == len(places) or places[high - 1] != places[high])
        if whole or high - low >= LONG:
            covered.update(range(low, high))
        first = i
    return covered


def _unique_blocks(tokens: list[str], places: list[int], starts: list[int], run: int) -> dict[int, list[str]]:
    """The open tokens that no boilerplate covers, by block."""
    covered = _covered(places, starts, run)
    kept: dict[int, list[str]] = {}
    for i, (token, place) in enumerate(zip(tokens, places, strict=True)):
        if place >= 0 and i not in covered:
            kept.setdefault(place, []).append(token)
    return kept


def _with_holders(streams: DataFrame) -> DataFrame:
    """The pages that have a host, with ``holder``: one number for all copies and near copies of a page on the host.

    Tables that are joined are written first, so that their sizes are known and small ones are broadcast.
    """
    named = streams.where("host != ''").withColumn("node", F.xxhash64("host", "body")).withColumn("site", F.xxhash64("host"))
    bands = F.sequence(F.lit(0), F.lit(len(_MULTIPLIERS) // BAND - 1))
    nodes = store(named.where(F.size("sketch") > 0).select("host", "node", "sketch").distinct())
    key = F.xxhash64("host", "band", F.slice("sketch", F.col("band") * BAND + 1, BAND)).alias("key")
    keyed = nodes.withColumn("band", F.explode(bands)).select("node", key)
    leaders = store(keyed.groupBy("key").agg(F.min("node").alias("leader"), F.max("node").alias("last")).where("leader < last"))
    pairs = store(keyed.join(leaders, "key").where("node > leader").select("node", "leader").distinct())
    others = nodes.select(F.col("node").alias("leader"), F.col("sketch").alias("other"))
    alike = F.size(F.filter(F.zip_with("sketch", "other", lambda a, b: a == b), lambda same: same))
    links = pairs.join(nodes, "node").join(others, "leader").where(alike >= ALIKE)
    roots = store(components(links.select(F.col("node").alias("u"), F.col("leader").alias("v"))))
    return named.join(roots, "node", "left").withColumn("holder", F.coalesce("root", "node")).drop("root", "node")


def _held(content: Column) -> Column:
    """What a host holds, as one short key."""
    return F.unhex(F.md5(F.concat_ws("\x00", "host", content))).alias("what")


def _repeated(held: DataFrame, sizes: DataFrame, share: float) -> DataFrame:
    """(``what``) that a share of the host's distinct pages hold."""
    counted = held.select("what", "site", "holder").distinct().groupBy("what", "site").agg(F.count("*").alias("n"))
    counted = counted.where(F.col("n") >= LEAST_PAGES).join(sizes, "site")
    return store(counted.where(F.col("n") >= share * F.col("size")).select("what"))


def boilerplate(pages: DataFrame, sizes: DataFrame, run: int) -> DataFrame:
    """(``_page``, ``starts``): where runs that the host repeats begin in the outer tokens."""
    last = F.size("tokens") - run
    at = F.explode(F.when(last >= 0, F.sequence(F.lit(0), last))).alias("at")
    suffixes = pages.select("_page", "host", "site", "holder", "tokens", at)
    beginning = F.array_join(F.slice("tokens", F.col("at") + 1, run), " ")
    suffixes = suffixes.select("_page", "site", "holder", "at", _held(beginning))
    repeated = _repeated(suffixes, sizes, OPEN_SHARE)
    return suffixes.join(repeated, "what", "left_semi").groupBy("_page").agg(F.collect_list("at").alias("starts"))


def repeated_blocks(pages: DataFrame, sizes: DataFrame) -> DataFrame:
    """(``_page``, ``gone``): the numbers of the main blocks that a large share of the host's pages hold as such."""
    block = F.explode(F.arrays_zip("numbers", "main")).alias("block")
    held = pages.select("_page", "host", "site", "holder", block).select(
        "_page", "site", "holder", F.col("block.numbers").alias("number"), _held(F.col("block.main"))
    )
    repeated = _repeated(held, sizes, MAIN_SHARE)
    return held.join(repeated, "what", "left_semi").groupBy("_page").agg(F.collect_list("number").alias("gone"))


def _text(tokens: list[str], places: list[int], starts: list[int], main: dict[int, str], run: int) -> str:
    """The main blocks, and the open ones without boilerplate if they are longer."""
    opened = _unique_blocks(tokens, places, starts, run)
    parts = dict(main)
    if sum(map(len, opened.values())) > sum(text.count(" ") + 1 for text in main.values()):
        parts |= {number: " ".join(words) for number, words in opened.items()}
    return "\n".join(parts[number] for number in sorted(parts))


def extract(pages: DataFrame, run: int = RUN) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page."""
    import pyarrow as pa

    fields = [
        ("tokens", "array<string>"), ("places", "array<bigint>"), ("numbers", "array<bigint>"), ("main", "array<string>"),
        ("body", "bigint"), ("sketch", "array<int>"),
    ]
    named = with_host_and_path(pages.select("page_id", "url", "html")).select("page_id", "url", "host", "html")
    # Written with their numbers, which tell repeated pages apart.
    streams = store(per_text(named, "html", fields, lambda: _read).withColumn("_page", F.monotonically_increasing_id()))
    held = _with_holders(streams)
    sizes = store(held.select("site", "holder").distinct().groupBy("site").agg(F.count("*").alias("size")))
    # Written, so that its size is known: where few pages repeat anything, the texts don't move.
    repeats = store(boilerplate(held, sizes, run).join(repeated_blocks(held, sizes), "_page", "full"))
    columns = ["tokens", "places", "starts", "numbers", "main", "gone"]
    joined = streams.join(repeats, "_page", "left").select("page_id", "url", *columns)

    def keep(batches):
        for batch in batches:
            texts = []
            for tokens, places, starts, numbers, main, gone in zip(*[batch.column(c).to_pylist() for c in columns], strict=True):
                stay = {n: text for n, text in zip(numbers, main, strict=True) if n not in (gone or [])}
                texts.append(_text(tokens, places, starts or [], stay, run))
            arrays = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["page_id", "url", "text"])

    schema = joined.select("page_id", "url", F.lit("").alias("text")).schema
    return joined.mapInArrow(keep, schema).withColumn("n_chars", F.length("text").cast("bigint"))
