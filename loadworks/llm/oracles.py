"""DuckDB SQL of the queries that SQL can express, written from the definitions alone."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANK = r"'[^\x20\x09-\x0D]+'"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

OP2 = f"""
WITH items AS (SELECT item_id, regexp_extract_all({_LOWER}, {_ALNUM}) AS w FROM benchmark),
grams AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size,
         array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS gram
  FROM items, LATERAL (SELECT unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM grams),
docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, {_ALNUM}) AS w FROM documents),
places AS (
  SELECT r, size, i, array_to_string(w[i:i + size - 1], ' ') AS gram
  FROM docs, sizes, LATERAL (SELECT unnest(range(1, len(w) - size + 2)) AS i) WHERE len(w) >= size),
found AS (SELECT r, p.size, i, item_id FROM places p JOIN grams g ON p.size = g.size AND p.gram = g.gram),
hits AS (
  SELECT r, count(DISTINCT k) AS n FROM (
    SELECT DISTINCT r, size, i FROM found), LATERAL (SELECT unnest(range(i, i + size)) AS k) GROUP BY r),
named AS (
  SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(m.n, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(h.n, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits h USING (r) LEFT JOIN named m USING (r)
"""

OP3 = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, {_BLANK}) AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + least(3, len(w)) - 1], ' ') AS s
  FROM docs, LATERAL (SELECT unnest(range(1, len(w) - least(3, len(w)) + 2)) AS i) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 85 * (x.n + y.n - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS v, doc_id AS label FROM docs
  UNION
  SELECT e.b, r.label FROM reach r JOIN both_ways e ON e.a = r.v WHERE r.label < e.b),
least_label AS (SELECT v, min(label) AS label FROM reach GROUP BY v)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, label AS component_id, d.doc_id = label AS kept
FROM docs d JOIN least_label l ON l.v = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""

OP5 = """
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
places AS (
  SELECT doc_id, i, substring(h, 2 * i + 1, 100) AS s
  FROM docs, LATERAL (SELECT unnest(range(0, len(h) // 2 - 49)) AS i) WHERE len(h) >= 100),
earliest AS (SELECT s, min(doc_id) AS least_id FROM places GROUP BY s HAVING count(*) > 1),
repeated AS (SELECT doc_id, i FROM places JOIN earliest USING (s) WHERE least_id < doc_id),
gone AS (
  SELECT DISTINCT doc_id, k FROM repeated, LATERAL (SELECT unnest(range(i, i + 50)) AS k)),
runs AS (
  SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE before IS NULL OR before < k - 1) AS spans
  FROM (SELECT doc_id, k, lag(k) OVER (PARTITION BY doc_id ORDER BY k) AS before FROM gone) GROUP BY doc_id),
kept AS (
  SELECT b.doc_id, string_agg(c, '' ORDER BY b.k) AS h FROM (
    SELECT doc_id, k, substring(h, 2 * k + 1, 2) AS c
    FROM docs JOIN runs USING (doc_id), LATERAL (SELECT unnest(range(0, len(h) // 2)) AS k)) b
  ANTI JOIN gone g ON g.doc_id = b.doc_id AND g.k = b.k GROUP BY b.doc_id)
SELECT d.doc_id, CAST(len(d.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN n IS NULL THEN d.h ELSE coalesce(k.h, '') END)) AS kept_sha256
FROM docs d LEFT JOIN runs USING (doc_id) LEFT JOIN kept k ON k.doc_id = d.doc_id
"""

OP8 = f"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_BLANK}) AS w FROM documents),
places AS (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS s
  FROM docs, LATERAL (SELECT unnest(range(1, len(w) - 18)) AS i) WHERE len(w) >= 20),
ranked AS (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM places),
gone AS (
  SELECT DISTINCT doc_id, k FROM (SELECT doc_id, i FROM ranked WHERE k > 1), LATERAL (SELECT unnest(range(i, i + 20)) AS k)),
kept AS (
  SELECT b.doc_id, count(g.k) AS n, string_agg(word, ' ' ORDER BY b.k) FILTER (WHERE g.k IS NULL) AS t
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM docs) b
  LEFT JOIN gone g ON g.doc_id = b.doc_id AND g.k = b.k GROUP BY b.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""

OP9 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
q AS (SELECT *, strlen(html) AS n, max(page_id) OVER (PARTITION BY html) AS last FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> last THEN last END AS refers_to, TRUE AS checked
FROM q
"""


def _field(name: str) -> str:
    text = f"CAST({name} AS VARCHAR)"
    return f"coalesce(strlen({text}) || ':' || {text}, '-')"


_HEAD = " || ".join(map(_field, ("doc_id", "source", "lang", "n_chars")))
# CRC-32 of the decimal digits, bit by bit: a digit is mixed in, then eight shifts.
_BITS = "flatten([[ord(c), -1, -1, -1, -1, -1, -1, -1, -1] for c in string_split(CAST(doc_id AS VARCHAR), '')])"
_CRC = (f"xor(list_reduce({_BITS}, lambda s, x: CASE WHEN x >= 0 THEN xor(s, x) WHEN s % 2 = 1 "
        "THEN xor(s // 2, 3988292384) ELSE s // 2 END, 4294967295), 4294967295)")


def _flank(frame: str) -> str:
    return ("coalesce(string_agg(h, '') OVER (PARTITION BY lvl, g, pos // 3 ORDER BY pos "
            f"ROWS BETWEEN {frame}), '')")


def _segments(nodes: str) -> str:
    return (f"SELECT lvl, g, pos, {_flank('UNBOUNDED PRECEDING AND 1 PRECEDING')} AS l, "
            f"{_flank('1 FOLLOWING AND UNBOUNDED FOLLOWING')} AS r FROM {nodes} WHERE n > 1")


def _grown(nodes: str) -> str:
    return (f"SELECT lvl + 1, g, (n + 2) // 3, pos // 3, sha256(string_agg(h, '' ORDER BY pos)) "
            f"FROM {nodes} WHERE n > 1 GROUP BY lvl, g, n, pos // 3")


def _walked(walk: str, segments: str) -> str:
    return (f"SELECT k, w.g, w.lvl + 1, w.pos // 3, sha256(s.l || cur || s.r), proof || s.l || s.r FROM {walk} w "
            f"JOIN {segments} s ON s.lvl = w.lvl AND s.g IS NOT DISTINCT FROM w.g AND s.pos = w.pos")


OP11 = f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, source, sha256({_HEAD} || {_field('text')}) AS leaf,
         CASE WHEN {_CRC} % 2 = 0 THEN sha256({_HEAD} || {_field("replace(text, chr(10), '')")}) END AS found
  FROM documents),
d AS (
  SELECT *, source AS g, row_number() OVER () AS k, count(*) OVER (PARTITION BY source) AS n,
         row_number() OVER (PARTITION BY source ORDER BY doc_id, leaf) - 1 AS pos FROM hashed),
nodes(lvl, g, n, pos, h) AS (SELECT 0, g, n, pos, leaf FROM d UNION ALL {_grown('nodes')}),
tops AS (
  SELECT lvl, g, h, count(*) OVER () AS n, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS pos FROM nodes WHERE n = 1),
upper(lvl, g, n, pos, h) AS (SELECT 0, 0, n, pos, h FROM tops UNION ALL {_grown('upper')}),
segments AS ({_segments('nodes')}),
upper_segments AS ({_segments('upper')}),
walk(k, g, lvl, pos, cur, proof) AS (
  SELECT k, g, 0, pos, coalesce(found, leaf), '' FROM d UNION ALL {_walked('walk', 'segments')}),
arrived AS (
  SELECT k, t.pos, cur, proof, t.h AS subroot FROM walk w JOIN tops t ON t.lvl = w.lvl AND t.g IS NOT DISTINCT FROM w.g),
climb(k, g, lvl, pos, cur, proof) AS (
  SELECT k, 0, 0, pos, cur, proof FROM arrived UNION ALL {_walked('climb', 'upper_segments')}),
root AS (SELECT lvl, h FROM upper WHERE n = 1)
SELECT d.doc_id, leaf, subroot, root.h AS root, sha256(c.proof) AS proof_sha256, c.cur AS folded_root,
       c.cur = root.h AS verified
FROM climb c JOIN root ON root.lvl = c.lvl JOIN d ON d.k = c.k JOIN arrived a ON a.k = c.k
"""

ORACLE = {"op2_decontaminate": OP2, "op3_near_duplicates": OP3, "op5_byte_dedup": OP5, "op8_word_dedup": OP8,
          "op9_warc": OP9, "op11_merkle_manifest": OP11}
