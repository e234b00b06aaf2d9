"""DuckDB SQL for the operators' queries that SQL expresses, written independently of the plans."""

from __future__ import annotations

from courtline.llm import chat, trie
from courtline.llm.licenses import TEMPLATES

# Pairs that share a shingle, tested on their full sets; components by reachability.
NEAR_DUPLICATES = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), shingled AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
  FROM words
), one AS (SELECT doc_id, unnest(s) AS x FROM shingled
), met AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM one a JOIN one b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2
), linked AS (
  SELECT a, b FROM met JOIN shingled p ON p.doc_id = a JOIN shingled q ON q.doc_id = b
  WHERE 100 * n >= 85 * (len(p.s) + len(q.s) - n)
), edges AS (SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM shingled
  UNION
  SELECT r.doc_id, e.b FROM reach r JOIN edges e ON r.other = e.a
), least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1)
SELECT s.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, s.doc_id = component_id AS kept
FROM shingled s JOIN least l ON s.doc_id = l.doc_id
"""

NEAREST_VECTORS = """
WITH sound AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND vec_id IS NOT NULL
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM sound q JOIN sound c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

_VALUES = ", ".join(f"('{name}', '{text}')" for name, text in TEMPLATES.items())

LICENSES = f"""
WITH files AS (
  SELECT doc_id, coalesce(source, 'unknown') || '/' || CAST(CAST(floor(doc_id / 1024) AS BIGINT) AS VARCHAR) || '/'
         || CAST(CAST(floor(doc_id / 64) AS BIGINT) AS VARCHAR) AS dir,
         CASE WHEN doc_id % 64 < 8 THEN 'LICENSE' ELSE CAST(doc_id AS VARCHAR) || '.txt' END AS name, text
  FROM documents
), template AS (
  SELECT name, unnest(list_distinct(list_filter(string_split_regex(lower(text), '[^a-z0-9]+'), lambda x: x <> ''))) AS t
  FROM (VALUES {_VALUES}) v(name, text)
), has AS (
  SELECT doc_id, unnest(list_distinct(list_filter(string_split_regex(lower(text), '[^a-z0-9]+'), lambda x: x <> ''))) AS t FROM files
), total AS (SELECT count(*) AS n FROM files
), weight AS (
  SELECT v.t, ln((1 + n) / (1 + count(h.doc_id))) + 1 AS w
  FROM (SELECT DISTINCT t FROM template) v CROSS JOIN total LEFT JOIN has h ON h.t = v.t GROUP BY v.t, n
), line AS (
  SELECT doc_id, row_number() OVER () AS line_id, list_distinct(list_filter(string_split_regex(lower(p), '[^a-z0-9]+'), lambda x: x <> '')) AS ts
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS p FROM files)
), lined AS (SELECT doc_id, line_id, unnest(ts) AS t FROM line
), norm AS (
  SELECT line_id, sum(pow(coalesce(w, ln((1 + n) / 2) + 1), 2)) AS s FROM lined LEFT JOIN weight USING (t) CROSS JOIN total GROUP BY 1
), template_norm AS (SELECT name, sqrt(sum(w * w)) AS s FROM template JOIN weight USING (t) GROUP BY 1
), cosine AS (
  SELECT l.doc_id, m.name, sum(w * w) / (sqrt(any_value(norm.s)) * any_value(template_norm.s)) AS score
  FROM lined l JOIN template m ON m.t = l.t JOIN weight ON weight.t = l.t JOIN norm ON norm.line_id = l.line_id
  JOIN template_norm ON template_norm.name = m.name GROUP BY l.doc_id, l.line_id, m.name
), own AS (
  SELECT doc_id, name AS license, round(score, 9) AS score FROM cosine WHERE score >= 0.75
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY round(score, 9) DESC, name DESC) = 1
), given AS (
  SELECT dir AS from_dir, license AS inherited FROM files JOIN own USING (doc_id) WHERE name = 'LICENSE'
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY score DESC, license) = 1
), above AS (
  SELECT DISTINCT dir, CASE WHEN depth = 0 THEN '' ELSE array_to_string(string_split(dir, '/')[1:depth], '/') END AS from_dir, depth
  FROM (SELECT dir, unnest(range(0, len(string_split(dir, '/')) + 1)) AS depth FROM (SELECT DISTINCT dir FROM files WHERE dir IS NOT NULL))
), nearest AS (
  SELECT dir, from_dir, inherited FROM above JOIN given USING (from_dir)
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY depth DESC) = 1
)
SELECT f.doc_id, f.dir || '/' || f.name AS path, o.license AS own_license, o.score AS own_score,
       CASE WHEN o.license IS NULL THEN n.from_dir END AS from_dir, CASE WHEN o.license IS NULL THEN n.inherited END AS inherited,
       coalesce(o.license, n.inherited) AS license
FROM files f LEFT JOIN own o ON o.doc_id = f.doc_id LEFT JOIN nearest n ON n.dir = f.dir
"""

ORACLE_SQL = {
    "op2_minhash": NEAR_DUPLICATES,
    "op5_licenses": LICENSES,
    "op8_chat": chat.ORACLE,
    "op9_topk": NEAREST_VECTORS,
    "op11_trie": trie.ORACLE,
}
