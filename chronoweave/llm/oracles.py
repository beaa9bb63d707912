"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from chronoweave.llm.url_filters import PATTERNS, RULES

_BLANKS = r"[\x20\x09-\x0D]+"

SUBSTRING_DEDUP = rf"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '{_BLANKS}'), lambda x: x <> '') AS ws FROM documents),
 g AS (SELECT doc_id, s, sha256(array_to_string(ws[s:s + 34], ' ')) AS h
    FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 34)) AS s FROM w WHERE len(ws) >= 35)),
 r AS (SELECT h FROM g GROUP BY h HAVING count(*) > 1),
 c AS (SELECT DISTINCT doc_id, s + k AS i FROM (SELECT doc_id, s, unnest(generate_series(0, 34)) AS k FROM g JOIN r USING (h))),
 k AS (SELECT doc_id, i, ws[i] AS word FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws))) AS i FROM w)),
 l AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n FROM k ANTI JOIN c USING (doc_id, i) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) -
    coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN l USING (doc_id)"""

def _near(shingle: int, percent: int) -> str:
    return rf"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_BLANKS}'), lambda x: x <> '') AS ws
    FROM documents),
 s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + {shingle - 1}], ' ') AS g
    FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - {shingle - 1}, CASE WHEN len(ws) > 0 THEN 1 ELSE 0 END))) AS i FROM w)),
 n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
 p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
 e AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * common >= {percent} * (a.n + b.n - common)),
 u AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
 t(node, seen) AS (SELECT doc_id, doc_id FROM documents UNION SELECT t.node, u.y FROM t JOIN u ON u.x = t.seen)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT node AS doc_id, min(seen) AS component_id FROM t GROUP BY node) m USING (doc_id)"""


NEAR_DEDUP = _near(3, 85)
NGRAM_JOIN = f"SELECT doc_id, n_shingles, component_id FROM ({_near(5, 80)})"

TOP_K = """
WITH v AS MATERIALIZED (SELECT row_number() OVER () AS id, vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v
 FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
 s AS (SELECT q.id, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
 FROM v q JOIN v c ON q.id <> c.id WHERE q.vec_id % 20 = 0),
 r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, vec_id) AS r FROM s)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM r WHERE r <= 20"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_PATTERN_ROWS = ", ".join(f"({_quoted(p.name)}, {_quoted(p.regex)})" for p in PATTERNS)
_RULE_ROWS = ", ".join(f"({_quoted(r.verdict)}, {_quoted(r.host)}, {_quoted(r.path)})" for r in RULES)

URL_FILTERS = f"""
WITH h AS (SELECT page_id, url, coalesce(CASE WHEN strpos(url, '://') > 0
    THEN translate(regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') END, '') AS host,
  coalesce(CASE WHEN strpos(url, '://') > 0
    THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) END, '') AS path FROM pages),
 f AS (SELECT * FROM (VALUES {_PATTERN_ROWS}) t(name, regex)), r AS (SELECT * FROM (VALUES {_RULE_ROWS}) t(verdict, host, path)),
 m AS (SELECT h.*, (SELECT min(name) FROM f WHERE regexp_matches(lower(h.url), regex)) AS pattern,
  (SELECT arg_max({{'rule': r.host || r.path, 'verdict': r.verdict}}, length(r.host || r.path) * 2 +
    CAST(r.verdict = 'block' AS INTEGER)) FROM r WHERE (h.host = r.host OR ends_with(h.host, '.' || r.host))
    AND starts_with(h.path, r.path)) AS fit FROM h)
SELECT page_id, host, path, fit.rule AS rule, coalesce(fit.verdict, CASE WHEN pattern IS NULL THEN 'allow'
    ELSE 'block' END) AS verdict, pattern FROM m"""


def _step(best: str, cost: str, letter: str, line: str = "''") -> str:
    """A way to edit that goes on from another one: costs and audits add up, repaired lines too."""
    return f"CASE WHEN {best} IS NULL THEN NULL ELSE {{'c': {best}.c + {cost}, 'a': {best}.a || '{letter}', 't': {best}.t || {line}}} END"


def _least(*ways: str) -> str:
    return f"list_aggregate([{', '.join(ways)}], 'min')"


_USER, _ASSISTANT = r"chr(10) || 'user:'", r"chr(10) || 'assistant:'"
_TO_USER = ("b0", "b1", "b3")


def _edited(state: int) -> str:
    """The best way to a state after one more row, from those before it with inserts done."""
    ways = [_step(f"b{state}", "2", "D")]
    keep = {1: ("s", ["b0"]), 2: ("u", list(_TO_USER)), 3: ("a", ["b2"])}.get(state)
    if keep:
        ways += [f"CASE WHEN NOT must AND initial = '{keep[0]}' THEN {_step(b, '5 * cut', 'K', 'line')} END" for b in keep[1]]
    if state in (2, 3):
        line = f"{_USER if state == 2 else _ASSISTANT} || text"
        ways += [f"CASE WHEN NOT must THEN {_step(b, '1 + 5 * cut', 'R', line)} END" for b in (_TO_USER if state == 2 else ("b2",))]
    return _least(*ways)


def _inserted(prefix: str) -> str:
    """The four states after inserts."""
    user = _least(f"{prefix}2", *[_step(f"{prefix}{q}", "5", "I", _USER) for q in (0, 1, 3)])
    return (f"{prefix}0 AS b0, {prefix}1 AS b1, {user} AS b2, "
        + _least(f"{prefix}3", _step(f"({user})", "5", "I", _ASSISTANT)) + " AS b3")


CONVERSATION_REPAIR = rf"""
WITH RECURSIVE z AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
    lambda c, k: xor(c >> 1, CAST(3988292384 AS BIGINT) * (c & 1)))) AS t),
 k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' ||
      coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda c, b: xor(c >> 8, z.t[(xor(c, b) & 255) + 1])), CAST(4294967295 AS BIGINT)) % 20 AS kind FROM conversations, z),
 d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM k, LATERAL (SELECT unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy) WHERE kind <> 0),
 n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS pos FROM d),
 f AS (SELECT *, left(role, 1) AS initial, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS again,
    NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS open, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) AS before FROM n),
 i AS (SELECT *, blank OR again AS must, CAST(NOT blank AND NOT again AND open AS INTEGER) AS cut,
    chr(10) || role || ':' || text AS line FROM f),
 c AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank,
    count_if(again AND NOT blank) AS duplicate, sum(cut) AS truncated,
    count_if(before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM i GROUP BY conv_id),
 p AS (SELECT conv_id, CAST(0 AS BIGINT) AS pos, {{'c': 0, 'a': '', 't': ''}} AS s0, CAST(NULL AS STRUCT(c INTEGER, a VARCHAR, t VARCHAR)) AS s1,
    CAST(NULL AS STRUCT(c INTEGER, a VARCHAR, t VARCHAR)) AS s2, CAST(NULL AS STRUCT(c INTEGER, a VARCHAR, t VARCHAR)) AS s3 FROM c
  UNION ALL SELECT i.conv_id, i.pos, {_edited(0)}, {_edited(1)}, {_edited(2)}, {_edited(3)}
  FROM (SELECT conv_id, pos, {_inserted("s")} FROM p) q JOIN i ON i.conv_id IS NOT DISTINCT FROM q.conv_id AND i.pos = q.pos + 1),
 e AS (SELECT conv_id, pos, {_least("b0", "b3")} AS best FROM (SELECT conv_id, pos, {_inserted("s")} FROM p))
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
  CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(best.c, 0) AS BIGINT) AS cost, coalesce(best.a, '') AS audit,
  sha256(coalesce(substr(best.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM o.conv_id AND e.pos = c.n"""

ORACLE_SQL = {"op1_substring_dedup": SUBSTRING_DEDUP, "op6_url_filters": URL_FILTERS, "op9_near_dedup": NEAR_DEDUP, "op10_top_k": TOP_K,
    "op11_conversation_repair": CONVERSATION_REPAIR, "op13_ngram_join": NGRAM_JOIN}
