"""The queries that SQL can express, in DuckDB SQL."""

from __future__ import annotations

BITS = ", ".join(f"'{i:04b}'" for i in range(16))

# The digest's 160 bits, five to a letter.
BASE32 = """
array_to_string(list_transform(range(0, 32), lambda i: substr(
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  CAST(1 + list_sum(list_transform(range(0, 5), lambda k:
    CAST(substr(bits, 5 * i + k + 1, 1) AS INT) * CAST(2 ** (4 - k) AS INT))) AS INT), 1)), '')"""

WARC_CAPTURES = f"""
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
digests AS (
  SELECT page_id, payload, array_to_string(list_transform(range(1, 41), lambda i:
           [{BITS}][instr('0123456789abcdef', substr(hex, i, 1))]), '') AS bits,
         min(page_id) OVER (PARTITION BY payload) AS first_id
  FROM payloads)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, {BASE32} AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to,
       CASE WHEN page_id = first_id THEN true END AS digest_ok
FROM digests"""

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# All pairs of documents with a common shingle, and everything that links lead to.
NEAR_DUPLICATES = rf"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, hash(unnest(CASE
      WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s
  FROM words),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS MATERIALIZED (
  SELECT a, b
  FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
        FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * common >= 75 * (p.n + q.n - common)),
reached AS (
  SELECT doc_id AS node, doc_id AS other FROM documents
  UNION
  SELECT node, b FROM reached JOIN links ON a = other)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id,
       d.doc_id = component_id AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
JOIN (SELECT node, min(other) AS component_id FROM reached GROUP BY node) ON node = d.doc_id"""

# Every document scored for every item, term by term.
RANKED_SEARCH = rf"""
WITH found AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
docs AS MATERIALIZED (SELECT doc_id, len(terms) AS n, terms FROM found WHERE len(terms) > 0),
stats AS MATERIALIZED (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS total FROM docs),
frequencies AS MATERIALIZED (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(terms) AS term FROM docs) GROUP BY ALL),
weights AS MATERIALIZED (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM frequencies GROUP BY term), stats),
asked AS MATERIALIZED (
  SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'),
                                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // total)))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN frequencies USING (term) JOIN docs USING (doc_id), stats
  GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
      FROM scored WHERE score > 0)
WHERE rank <= 20"""

ORACLE: dict[str, str] = {
    "op1_warc_captures": WARC_CAPTURES,
    "op4_near_duplicates": NEAR_DUPLICATES,
    "op12_accumulator_search": RANKED_SEARCH,
}
