"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

import re

from ddlscope.llm.ledger import PEM

# The patterns of the kinds, in the order of the report.
KINDS = [
    ("assign", r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", "AKIA[A-Z0-9]+", 0, 16),
    ("hex", "[0-9a-f]+", 0, 32),
    ("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 1),
    ("pem", re.sub(r"(?<=[)])([*+])[+]", r"\1", PEM).replace("'", "''"), 0, 1),  # RE2 has no possessive marks
]
_FOUND = " UNION ALL ".join(
    f"SELECT row, {rank} AS rank, '{kind}' AS kind, {least} AS least, regexp_extract_all(t, '{pattern}') AS m, "
    f"regexp_extract_all(t, '{pattern}', {group}) AS v, string_split_regex(t, '{pattern}') AS g FROM texts "
    f"WHERE regexp_matches(t, '{pattern if kind != 'hex' else '[0-9a-f]{32}'}')"
    for rank, (kind, pattern, group, least) in enumerate(KINDS))
OP1 = f"""
WITH texts AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({_FOUND}),
each AS (SELECT row, rank, kind, least, unnest(m) AS m, unnest(v) AS v, unnest(g[1:len(m)]) AS g, unnest(range(len(m))) AS i FROM found),
placed AS (SELECT *, sum(length(g) + length(m)) OVER (PARTITION BY row, rank ORDER BY i) AS e FROM each),
spans AS (SELECT row, rank, e - length(m) AS s, kind || ':' || (e - length(m))::BIGINT || ':' || e::BIGINT AS span
  FROM placed WHERE length(v) >= least),
per_row AS (SELECT row, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access,
  count(*) FILTER (rank = 2) AS n_hex, string_agg(span, ',' ORDER BY s, rank) FILTER (rank < 3) AS base,
  string_agg(span, ',' ORDER BY s, rank) AS spans FROM spans GROUP BY row)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN per_row USING (row)"""

# A page with an equal payload of 1000 bytes or more and a larger id is revisited.
OP3 = """
WITH sized AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
digests AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS payload_digest FROM sized),
last AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS kept FROM digests)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN kept = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN kept <> page_id THEN kept END AS refers_to FROM last"""

# Sums of whole numbers below 2**53 are exact as doubles.
OP11 = """
WITH vectors AS (SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.row, a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM vectors a JOIN vectors b ON a.vec_id % 50 = 0),
positives AS (SELECT row, anchor_id, id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY row ORDER BY score DESC, id) AS place
  FROM scored WHERE same AND id <> anchor_id QUALIFY place <= 5),
ranked AS (SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.row, place ORDER BY score DESC, id)::INTEGER AS rank, id AS negative_id,
  positive_score, score AS negative_score FROM positives p JOIN scored s ON s.row = p.row AND NOT s.same
    AND 100 * score BETWEEN 50 * positive_score AND 95 * positive_score)
SELECT * FROM ranked WHERE rank <= 3"""

# Lines by key; the key folds A to Z only.
OP13 = """
WITH texts AS (SELECT row_number() OVER () AS row, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
each AS (SELECT row, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM texts),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM each),
repeated AS (SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT keyed.*, coalesce(doc_id < keeper, false) AS gone FROM keyed LEFT JOIN repeated USING (k))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256 FROM marked GROUP BY row"""

SQL: dict[str, str] = {"op1_secret_scan": OP1, "op3_warc": OP3, "op11_hard_negatives": OP11, "op13_line_dedup": OP13}
