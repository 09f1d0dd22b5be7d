"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from dimspark.llm.urls import RULES, SOFT, STRICT

_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

# The common level rises until no further source is full. With sources in the order in which they fill up, a source
# is full if its share at the level that those before it leave is more than it can take.
OP2 = rf"""
WITH docs AS (
  SELECT doc_id, source, {_WORDS}::BIGINT AS size,
         md5(concat_ws(':', '42', doc_id::VARCHAR, md5(coalesce(text, '')))) AS k
  FROM documents),
sources AS (
  SELECT source, sum(size)::HUGEINT AS s,
         ((row_number() OVER (ORDER BY (source IS NULL), source) - 1) % 3 + 1)::HUGEINT AS w
  FROM docs GROUP BY source),
filled AS (
  SELECT *, sum(s) OVER () - coalesce(sum(3 * s) OVER before, 0) AS budget,
         sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS weight
  FROM sources
  WINDOW before AS (ORDER BY 3 * s / w::DOUBLE, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT budget, weight FROM filled WHERE w * budget <= 3 * s * weight ORDER BY 3 * s / w::DOUBLE, source IS NULL, source LIMIT 1),
targets AS (
  SELECT source, s, least((3 * s)::DOUBLE, (w * (SELECT budget FROM level))::DOUBLE / (SELECT weight FROM level)::DOUBLE) AS target
  FROM sources),
placed AS (
  SELECT d.*, t.s, t.target, floor(t.target)::HUGEINT AS goal,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before_it
  FROM docs d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, s::BIGINT AS source_size, target,
       (CASE WHEN s = 0 THEN 0 ELSE (goal // s) * size + greatest(0, least(size, goal % s - before_it)) END)::BIGINT AS taken
FROM placed
"""


def _op4() -> str:
    rules = sorted(RULES, key=lambda r: -len(r[0] + r[1]))

    def fits(host: str, path: str) -> str:
        return f"((host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}'))"

    def hit(term: str) -> str:
        return rf"regexp_matches(lower(coalesce(url, '')), '(^|[^\pL\pN]){term}([^\pL\pN]|$)')::INT"

    rule = " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for h, p, _ in rules)
    action = " ".join(f"WHEN {fits(h, p)} THEN '{a}'" for h, p, a in rules)
    strict, soft = (" + ".join(map(hit, terms)) for terms in (STRICT, SOFT))
    return rf"""
WITH cut AS (
  SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
named AS (
  SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM cut)
SELECT page_id, host, path, CASE {rule} ELSE NULL END AS rule,
       CASE {action} WHEN {strict} > 0 OR {soft} >= 2 THEN 'block' ELSE 'allow' END AS verdict
FROM named
"""


def _words(text: str) -> str:
    folded = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"regexp_extract_all({folded}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


OP5 = f"""
WITH items AS (SELECT item_id, {_words("text")} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, array_to_string(w[i : i + 12], ' ') AS g, len(w[i : i + 12]) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_words("text")} AS w FROM documents),
grams AS (
  SELECT r, i, n, array_to_string(w[i : i + n - 1], ' ') AS g
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
matched AS (SELECT r, i, m.n, item_id FROM grams m JOIN windows x ON m.g = x.g AND m.n = x.n),
hits AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM matched) GROUP BY r),
found AS (
  SELECT r, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM (SELECT DISTINCT r, item_id FROM matched) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN found USING (r)
"""


def _crc32(text: str) -> str:
    """The unsigned checksum of a text in UTF-8."""
    step = "lambda x, _: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)"
    of_byte = f"list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], {step})"
    codes = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), lambda c, b: {of_byte}), 4294967295::BIGINT)"


def _op11(levels: int = 10) -> str:
    """The trees of languages and the tree over them, unrolled level by level: 8**levels leaves in each."""

    def written(field: str) -> str:
        return f"coalesce(strlen({field}::VARCHAR)::VARCHAR || ':' || {field}::VARCHAR, '-')"

    def hashed(text: str) -> str:
        fields = ["doc_id", "source", "lang", "n_chars", text]
        return f"sha256(concat({', '.join(map(written, fields))}))"

    def tree(name: str, leaves: str) -> list[str]:
        """``{name}{i}``: the digests (t, i, d) of a level, as long as several remain; ``{name}runs``: all runs of children."""
        parts = [f"{name}0 AS MATERIALIZED ({leaves})"]
        for level in range(1, levels + 1):
            below = f"{name}{level - 1}"
            parts.append(
                f"{name}{level} AS MATERIALIZED (SELECT t, i // 8 AS i, sha256(string_agg(d, '' ORDER BY i)) AS d, string_agg(d, '' ORDER BY i) AS run "
                f"FROM (SELECT t, i, d, count(*) OVER (PARTITION BY t) AS n FROM {below}) WHERE n > 1 GROUP BY t, i // 8)"
            )
        runs = " UNION ALL ".join(f"SELECT {level} AS level, t, i, d, run FROM {name}{level}" for level in range(1, levels + 1))
        parts.append(f"{name}runs AS MATERIALIZED ({runs})")
        ends = f"SELECT 0 AS level, t, i, d FROM {name}0 UNION ALL SELECT level, t, i, d FROM {name}runs"
        parts.append(f"{name}top AS MATERIALIZED (SELECT t, max_by(d, level) AS d FROM ({ends}) GROUP BY t)")
        return parts

    def folded(name: str, runs: str, start: str) -> list[str]:
        """From (doc, t, i, cur, proof) rows: one table a level, in which ``cur`` replaces its place in the run."""
        parts = [f"{name}0 AS MATERIALIZED ({start})"]
        for level in range(1, levels + 1):
            parts.append(
                f"{name}{level} AS MATERIALIZED (SELECT f.doc, f.t, f.i // 8 AS i, "
                f"CASE WHEN r.run IS NULL THEN cur ELSE sha256(substr(run, 1, 64 * (f.i % 8)::BIGINT) || cur || substr(run, 64 * (f.i % 8)::BIGINT + 65)) END AS cur, "
                f"CASE WHEN r.run IS NULL THEN proof ELSE proof || substr(run, 1, 64 * (f.i % 8)::BIGINT) || substr(run, 64 * (f.i % 8)::BIGINT + 65) END AS proof "
                f"FROM {name}{level - 1} f LEFT JOIN (SELECT * FROM {runs} WHERE level = {level}) r ON f.t = r.t AND f.i // 8 = r.i)"
            )
        return parts

    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    parts = [
        f"""leaves AS MATERIALIZED (
  SELECT row_number() OVER () AS doc, doc_id, coalesce('=' || lang, '') AS t, {hashed("text")} AS leaf,
         CASE WHEN {_crc32("doc_id::VARCHAR")} % 3 = 0 THEN {hashed(lowered)} ELSE {hashed("text")} END AS changed
  FROM documents)""",
        "placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM leaves)",
        *tree("a", "SELECT t, i, leaf AS d FROM placed"),
        "langs AS MATERIALIZED (SELECT t AS of_lang, '' AS t, row_number() OVER (ORDER BY t) - 1 AS i, d FROM atop)",
        *tree("b", "SELECT t, i, d FROM langs"),
        *folded("f", "aruns", "SELECT doc, t, i, changed AS cur, '' AS proof FROM placed"),
        *folded("g", "bruns", f"SELECT f.doc, l.t, l.i, f.cur, f.proof FROM f{levels} f JOIN langs l ON f.t = l.of_lang"),
    ]
    return f"""WITH {", ".join(parts)}
SELECT p.doc_id, p.leaf, s.d AS subroot, r.d AS root, sha256(g.proof) AS proof_sha256, g.cur AS folded_root, g.cur = r.d AS verified
FROM placed p JOIN atop s USING (t) JOIN g{levels} g USING (doc), btop r
"""


# Ranks within sources by the random key; all by fractional rank; sixteen even cuts.
OP8 = f"""
WITH docs AS (
  SELECT doc_id, source, coalesce(text, '') AS t, md5(concat_ws(':', '42', doc_id::VARCHAR, md5(coalesce(text, '')))) AS k FROM documents),
ranked AS (
  SELECT *, ((row_number() OVER (PARTITION BY source ORDER BY k) - 1)::DOUBLE + 0.5) / (count(*) OVER (PARTITION BY source))::DOUBLE AS share FROM docs),
placed AS (
  SELECT *, row_number() OVER (ORDER BY share, source IS NULL, source, k) - 1 AS n, count(*) OVER () AS total FROM ranked)
SELECT doc_id, (strlen(t) + 1)::BIGINT AS size, {_crc32("t")}::BIGINT AS text_crc32, 'rows' AS law, (n * 16 // total)::INT AS shard,
       (n - (n * 16 // total * total + 15) // 16)::BIGINT AS slot, NULL::INT AS grown_shard
FROM placed
"""

_CONV_KEY = "concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' '))"

# Row by row, the least cost and audit for each state; up to two inserts before an edit, as more come back to a state.
OP13 = rf"""
WITH RECURSIVE hit AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc32(_CONV_KEY)} % 20 AS hit, row_number() OVER () AS r
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
         CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN hit = 3 THEN [2 * r, 2 * r + 1] ELSE [2 * r] END) AS copy
  FROM hit WHERE hit <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth
  FROM damaged),
judged AS MATERIALIZED (
  SELECT *, substr(role, 1, 1) AS c,
         CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'b' WHEN nth > 1 THEN 'd'
              WHEN NOT regexp_matches(text, '[.!?][ 	-
]*\z') THEN 't' ELSE '' END AS fault
  FROM placed),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS n,
         count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated
  FROM judged GROUP BY conv_id),
pairs AS (
  SELECT conv_id, count(*) FILTER (before || c NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT conv_id, c, lag(c) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM judged) GROUP BY conv_id),
inserts(q, n, to_q, added) AS (
  VALUES ('-', 0, '-', []), ('-', 1, 'u', ['user:']), ('-', 2, 'a', ['user:', 'assistant:']),
         ('s', 0, 's', []), ('s', 1, 'u', ['user:']), ('s', 2, 'a', ['user:', 'assistant:']),
         ('a', 0, 'a', []), ('a', 1, 'u', ['user:']), ('a', 2, 'a', ['user:', 'assistant:']),
         ('u', 0, 'u', []), ('u', 1, 'a', ['assistant:']), ('u', 2, 'u', ['assistant:', 'user:'])),
edits(q, edit, to_q, role) AS (
  VALUES ('-', 'D', '-', ''), ('s', 'D', 's', ''), ('u', 'D', 'u', ''), ('a', 'D', 'a', ''),
         ('-', 'K', 's', ''), ('-', 'K', 'u', ''), ('s', 'K', 'u', ''), ('a', 'K', 'u', ''), ('u', 'K', 'a', ''),
         ('-', 'R', 'u', 'user'), ('s', 'R', 'u', 'user'), ('a', 'R', 'u', 'user'), ('u', 'R', 'a', 'assistant')),
steps AS (
  SELECT conv_id, 0::BIGINT AS i, '-' AS q, {{'cost': 0::BIGINT, 'audit': '', 'lines': []::VARCHAR[]}} AS b FROM counts
  UNION ALL
  SELECT conv_id, i, q, min(b) FROM (
    SELECT s.conv_id, s.i + 1 AS i, e.to_q AS q,
           {{'cost': s.b.cost + 3 * n.n + CASE edit WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END + CASE WHEN edit <> 'D' AND fault = 't' THEN 3 ELSE 0 END,
             'audit': s.b.audit || repeat('I', n.n) || edit,
             'lines': list_concat(s.b.lines, n.added, CASE edit WHEN 'D' THEN []::VARCHAR[] WHEN 'K' THEN [r.role || ':' || text] ELSE [e.role || ':' || text] END)}} AS b
    FROM steps s JOIN judged r ON s.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = s.i + 1
    JOIN inserts n ON n.q = s.q JOIN edits e ON e.q = n.to_q
    WHERE (edit = 'D' OR fault IN ('', 't')) AND (edit <> 'K' OR c = e.to_q)) GROUP BY conv_id, i, q),
ended AS (
  SELECT s.conv_id, min({{'cost': s.b.cost + 3 * n.n, 'audit': s.b.audit || repeat('I', n.n), 'lines': list_concat(s.b.lines, n.added)}}) AS b
  FROM steps s JOIN counts k ON s.conv_id IS NOT DISTINCT FROM k.conv_id AND s.i = k.n JOIN inserts n ON n.q = s.q
  WHERE n.to_q IN ('-', 'a') GROUP BY s.conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(b.cost, 0)::BIGINT AS cost,
       coalesce(b.audit, '') AS audit, sha256(coalesce(array_to_string(b.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN counts k ON c.conv_id IS NOT DISTINCT FROM k.conv_id
LEFT JOIN pairs p ON c.conv_id IS NOT DISTINCT FROM p.conv_id LEFT JOIN ended e ON c.conv_id IS NOT DISTINCT FROM e.conv_id
"""

ORACLES = {"op11_merkle": _op11(), "op13_repair": OP13, "op8_sharding": OP8, "op2_mixing": OP2, "op4_urls": _op4(), "op5_decontamination": OP5}
