"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from math import ceil

from pricelens.llm.licenses import BLOCK_WORDS, PHRASES, TEMPLATES, THRESHOLD, needed, template_length, template_sets

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _alnum(text: str) -> str:
    return (
        f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), "
        r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    )


DECONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_alnum("text")} AS w FROM documents),
i AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_alnum("text")} AS w FROM benchmark),
i2 AS (SELECT item, w, least(len(w), 10) AS k FROM i WHERE len(w) > 0),
iw AS (SELECT item, k, w[p:p + k - 1] AS win
       FROM (SELECT item, w, k, unnest(generate_series(1, len(w) - k + 1)) AS p FROM i2)),
ks AS (SELECT DISTINCT k FROM iw),
dw AS (SELECT rid, p, k, w[p:p + k - 1] AS win
       FROM (SELECT rid, w, k, unnest(generate_series(1, len(w) - k + 1)) AS p FROM d, ks WHERE len(w) >= k)),
h AS (SELECT dw.rid, dw.p, dw.k, iw.item FROM dw JOIN iw ON dw.k = iw.k AND dw.win = iw.win),
n AS (SELECT rid, count(DISTINCT q) AS n_hit
      FROM (SELECT rid, unnest(generate_series(p, p + k - 1)) AS q FROM h) GROUP BY rid),
m AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT rid, item FROM h) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (rid) LEFT JOIN m USING (rid)
"""


def _list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


_PLACES = " UNION ALL ".join(
    f"SELECT rid, p - 1 AS p, '{label}' AS label FROM "
    f"(SELECT rid, w, unnest(generate_series(1, len(w) - {len(phrase.split()) - 1})) AS p FROM d) "
    f"WHERE w[p:p + {len(phrase.split()) - 1}] = {_list(phrase.split())}"
    for phrase, label in PHRASES
)
_BLOCKS = " UNION ALL ".join(
    f"SELECT rid, '{label}' AS label, len(list_intersect(w, {_list(words)})) / {len(words)} AS c "
    f"FROM b WHERE len(w) <= {BLOCK_WORDS} AND len(list_intersect(w, {_list(words)})) >= {needed(len(words), THRESHOLD)}"
    for label, words in template_sets()
)
_RUNS = " UNION ALL ".join(
    f"SELECT rid, '{label}' AS label, max(c) / {len(words)} AS c FROM ("
    f"SELECT rid, len(list_intersect(w[p:p + {ceil(template_length(text) / THRESHOLD - 1e-9) - 1}], {_list(words)})) AS c "
    f"FROM (SELECT rid, w, unnest(generate_series(1, len(w))) AS p FROM d "
    f"WHERE len(list_intersect(w, {_list(words)})) >= {needed(len(words), THRESHOLD)}) "
    f"WHERE list_contains({_list(words)}, w[p])) GROUP BY rid HAVING max(c) >= {needed(len(words), THRESHOLD)}"
    for (text, _), (label, words) in zip(TEMPLATES, template_sets(), strict=True)
)
LICENSES = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, text, {_alnum("text")} AS w FROM documents),
places AS ({_PLACES}),
lines AS (SELECT rid, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM d),
b AS (SELECT rid, {_alnum("line")} AS w FROM lines),
found AS ({_BLOCKS} UNION ALL {_RUNS}),
base AS (SELECT rid, count(*) AS n_base, min(p) AS first_word, max(p) AS last_word,
           string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM places GROUP BY rid),
every AS (SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
          FROM (SELECT rid, label FROM places UNION ALL SELECT rid, label FROM found) GROUP BY rid),
best AS (SELECT rid, max(c) AS c FROM found GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
  CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  CAST(CASE WHEN n_base > 0 THEN 1 ELSE coalesce(c, 0) END AS DOUBLE) AS score
FROM d LEFT JOIN base USING (rid) LEFT JOIN every USING (rid) LEFT JOIN best USING (rid)
"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (SELECT page_id, octet_length(CAST(encode(payload) AS BLOB)) AS n, sha256(payload) AS h FROM p),
f AS (SELECT h, min(page_id) AS first_id, count(*) AS c FROM d WHERE n >= 100 GROUP BY h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d.h AS payload_digest,
  CASE WHEN c > 1 AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN c > 1 AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM d LEFT JOIN f ON d.h = f.h AND d.n >= 100
"""

LINES = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT rid, p, lines[p] AS line,
        translate(trim(lines[p], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') AS key
      FROM (SELECT rid, lines, unnest(generate_series(1, len(lines))) AS p FROM d)),
often AS (SELECT key FROM l WHERE len(key) >= 1 GROUP BY key HAVING count(DISTINCT rid) >= 10),
k AS (SELECT rid, string_agg(line, chr(10) ORDER BY p) AS kept, count(*) AS n_kept FROM l
      WHERE key NOT IN (SELECT key FROM often) GROUP BY rid)
SELECT doc_id, CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - coalesce(n_kept, 0) AS BIGINT) AS n_dropped,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (rid)
"""


def _field(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"coalesce(octet_length(encode({text})) || ':' || {text}, '-')"


def _tree(start: str, end: str, levels: int) -> str:
    """Levels ``{end}0 ..`` above the nodes ``start``, and each node's siblings at every level, left and right."""
    parts = [f"{end}0 AS (SELECT tree, i, n, h FROM {start})"]
    for j in range(levels):
        parts.append(f"""{end}{j + 1} AS (SELECT tree, i // 3 AS i, max((n + 2) // 3) AS n,
  CASE WHEN max(n) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE max(h) END AS h FROM {end}{j} GROUP BY tree, i // 3)""")
        parts.append(f"""{end}s{j} AS (SELECT a.tree, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l,
  coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r
  FROM {end}{j} a JOIN {end}{j} b ON a.tree = b.tree AND a.i // 3 = b.i // 3 WHERE a.n > 1 GROUP BY a.tree, a.i)""")
    return ",\n".join(parts)


def _climb(start: str, end: str, tree: str, levels: int) -> str:
    """Rows ``start`` with the hash ``f`` and the siblings ``proof`` carried up the tree."""
    parts = [f"{end}0 AS (SELECT * FROM {start})"]
    for j in range(levels):
        parts.append(f"""{end}{j + 1} AS (SELECT p.* EXCLUDE (i, f, proof), p.i // 3 AS i,
  CASE WHEN s.tree IS NULL THEN f ELSE sha256(l || f || r) END AS f, proof || coalesce(l || r, '') AS proof
  FROM {end}{j} p LEFT JOIN {tree}s{j} s ON p.tree = s.tree AND p.i = s.i)""")
    return ",\n".join(parts)


_CRC_STEPS = ",\n".join(
    f"c{k + 1} AS (SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END AS c FROM c{k})" for k in range(8)
)
_LEVELS = 14  # 3 ** 14 documents a source
MERKLE = f"""
WITH c0 AS (SELECT CAST(range AS BIGINT) AS i, CAST(range AS BIGINT) AS c FROM range(256)),
{_CRC_STEPS},
tab AS (SELECT list(c ORDER BY i) AS t FROM c8),
d AS (SELECT row_number() OVER () AS rid, *, coalesce('=' || CAST(source AS VARCHAR), '') AS tree, CAST(doc_id AS VARCHAR) AS name FROM documents),
b AS (SELECT rid, CAST(ascii(substr(name, p, 1)) AS BIGINT) AS byte, p FROM
      (SELECT rid, name, unnest(generate_series(1, len(name))) AS p FROM d WHERE name IS NOT NULL)),
bs AS (SELECT rid, list_prepend(4294967295::BIGINT, list(byte ORDER BY p)) AS bytes FROM b GROUP BY rid),
k AS (SELECT rid, list_reduce(bytes, lambda s, x: xor(s >> 8, t[(xor(s, x) & 255) + 1])) & 1 AS odd FROM bs, tab),
e AS (SELECT d.rid, doc_id, tree,
        sha256({" || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))}) AS leaf,
        CASE WHEN odd = 1 THEN sha256({" || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", "replace(text, chr(10), '')"))}) END AS tampered
      FROM d LEFT JOIN k ON d.rid = k.rid),
placed AS (SELECT rid, doc_id, tree, leaf, tampered, leaf AS h, count(*) OVER (PARTITION BY tree) AS n,
             row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM e),
{_tree("placed", "a", _LEVELS)},
subs AS (SELECT tree AS sub, h, '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM a{_LEVELS}),
{_tree("subs", "t", _LEVELS)},
leaves AS (SELECT rid, doc_id, tree, i, leaf, coalesce(tampered, leaf) AS f, '' AS proof FROM placed),
{_climb("leaves", "u", "a", _LEVELS)},
up AS (SELECT u.doc_id, u.leaf, u.f, u.proof, subs.h AS subroot, '' AS tree, subs.i AS i FROM u{_LEVELS} u JOIN subs ON u.tree = subs.sub),
{_climb("up", "v", "t", _LEVELS)}
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, f AS folded_root, f = root AS verified
FROM v{_LEVELS}, (SELECT h AS root FROM t{_LEVELS})
"""

JACCARD = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id,
  regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT rid, array_to_string(w[p:p + k - 1], ' ') AS s
       FROM (SELECT rid, w, k, unnest(generate_series(1, len(w) - k + 1)) AS p
             FROM (SELECT rid, w, least(len(w), 5) AS k FROM d WHERE len(w) > 0))),
n AS (SELECT rid, count(*) AS n FROM sh GROUP BY rid),
o AS (SELECT a.rid AS x, b.rid AS y, count(*) AS o FROM sh a JOIN sh b ON a.s = b.s AND a.rid < b.rid GROUP BY ALL),
l AS (SELECT x, y FROM o JOIN n a ON a.rid = x JOIN n b ON b.rid = y WHERE 100 * o >= 80 * (a.n + b.n - o)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(rid, other) AS (SELECT rid, rid FROM d UNION SELECT r.rid, e.y FROM r JOIN e ON r.other = e.x),
c AS (SELECT r.rid, min(d.doc_id) AS component FROM r JOIN d ON r.other = d.rid GROUP BY r.rid)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component AS component_id
FROM d JOIN c ON d.rid = c.rid LEFT JOIN n ON d.rid = n.rid
"""

REPEATS = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS x,
  octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT rid, p, md5(substr(x, 2 * p - 1, 400)) AS h
      FROM (SELECT rid, x, unnest(generate_series(1, n - 199)) AS p FROM d WHERE n >= 200)),
again AS (SELECT h FROM w GROUP BY h HAVING count(*) > 1),
hit AS (SELECT rid, p, p - lag(p) OVER (PARTITION BY rid ORDER BY p) AS step FROM w WHERE h IN (SELECT h FROM again)),
g AS (SELECT rid, p, sum(CASE WHEN step <= 200 THEN 0 ELSE 1 END) OVER (PARTITION BY rid ORDER BY p) AS run FROM hit),
s AS (SELECT rid, run, min(p) AS a, max(p) + 199 AS b FROM g GROUP BY rid, run),
t AS (SELECT rid, run, a, b, coalesce(lag(b) OVER (PARTITION BY rid ORDER BY run), 0) AS before FROM s),
k AS (SELECT t.rid, sum(b - a + 1) AS removed, count(*) AS spans, max(b) AS last,
        string_agg(substr(x, 2 * before + 1, 2 * (a - 1 - before)), '' ORDER BY run) AS kept
      FROM t JOIN d ON t.rid = d.rid GROUP BY t.rid)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(kept, '') || substr(x, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN k ON d.rid = k.rid
"""

ORACLES: dict[str, str] = {
    "op2_jaccard_join": JACCARD,
    "op9_suffix_dedup": REPEATS,
    "op13_merkle": MERKLE,
    "op11_line_dedup": LINES,
    "op3_warc": WARC,
    "op6_decontamination": DECONTAMINATION,
    "op8_license_scan": LICENSES,
}
