"""The operators' contracts in plain Python, for small tables."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import xxhash

LONG = " ".join(f"w{i % 997}x{i % 13}" for i in range(30_000))
NATURAL = "the cat sat on a mat and looked at every bird that flew by while rain fell over old roofs in town again tonight"

#: Columns that operators add or use inside.
CLASHING = "size kept _n fp shard slot taken n_words host score target row key _key _source text_ _text".split()


def messy_rows():
    rng = random.Random(5)
    words = [f"word{i}" for i in range(300)]
    rows = [(None, None, None), (1, None, "b"), (2, "", "b"), (3, "   \n\t ", None), (4, LONG, "a")]
    rows += [(5, "same text of a few words", "a")] * 3 + [(6, "same text of a few words", "b"), (None, "null id", "c")]
    rows += [(5, "another text under the same id", "c")]
    for i in range(10, 70):
        rows.append((i, " ".join(rng.choice(words) for _ in range(rng.choice([3, 40, 90]))), rng.choice("abcdé")))
    return rows


def messy_docs(spark):
    rows = [(*r, *["x"] * len(CLASHING)) for r in messy_rows()]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"{c} string" for c in CLASHING))


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def code_point(source):
    return (source is None, source or "")


def targets(rows, most=3):
    """{source: (size, target)}; rows: (source, size)."""
    sizes = Counter()
    for source, size in rows:
        sizes[source] += size
    weight = {s: i % 3 + 1 for i, s in enumerate(sorted(sizes, key=code_point))}
    full, total = set(), sum(sizes.values())
    while True:
        left = total - sum(most * sizes[s] for s in full)
        over = {s for s in sizes if s not in full and weight[s] * left > most * sizes[s] * sum(weight[t] for t in sizes if t not in full)}
        if not over:
            break
        full |= over
    share = sum(weight[t] for t in sizes if t not in full)
    return {s: (sizes[s], float(most * sizes[s]) if s in full else min(most * sizes[s], weight[s] * left / share)) for s in sizes}


def fingerprint(text):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps, radius=2):
    """The index of each fingerprint's component."""
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def contamination(docs, items, window=13):
    """(doc_id, n_words, n_hit, n_items, digest, contaminated) of (doc_id, text) rows."""
    windows = defaultdict(set)
    for item, text in items:
        w = item_words(text)
        for at in range(max(len(w) - window, 0) + 1) if w else ():
            windows[tuple(w[at : at + window])].add(str(item))
    found = []
    for doc, text in docs:
        w, hit, ids = item_words(text), set(), set()
        for n in {len(x) for x in windows}:
            for at in range(len(w) - n + 1):
                if tuple(w[at : at + n]) in windows:
                    hit |= set(range(at, at + n))
                    ids |= windows[tuple(w[at : at + n])]
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        found.append((doc, len(w), len(hit), len(ids), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return found


def quality_measures(text):
    text = text or ""
    w = words(text)
    triples = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) if triples[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if words(x)]
    return (
        len(w),
        sum(map(len, w)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines) - len(set(lines)),
        len(covered),
    )


def luhn(digits):
    doubled = [int(d) * 2 - 9 * (int(d) > 4) if i % 2 else int(d) for i, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def personal_data(text):
    """(start, place of the kind, end) of base matches."""
    forms = [
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        r"[0-9]([\x20-]?[0-9])+",
        r"\+[0-9][\x20().0-9-]+[0-9]",
    ]
    tests = [
        lambda v, d: True,
        lambda v, d: max(map(int, v.split("."))) <= 255,
        lambda v, d: 14 <= len(d) <= 19 and luhn(d),
        lambda v, d: 10 <= len(d) <= 15,
    ]
    return sorted(
        (m.start(), k, m.end())
        for k, form in enumerate(forms)
        for m in re.finditer(form, text or "")
        if tests[k](m.group(), re.sub("[^0-9]", "", m.group()))
    )


def secrets(text):
    forms = {
        "assign": (r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
        "access": (r"AKIA[A-Z0-9]+", 0, 18),
        "hex": (r"[0-9a-f]+", 0, 16),
    }
    return sorted(
        (m.start(), place, f"{kind}:{m.start()}:{m.end()}")
        for place, (kind, (form, group, least)) in enumerate(forms.items())
        for m in re.finditer(form, text or "")
        if len(m.group(group)) >= least
    )


def near(a, b):
    return math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-9)
