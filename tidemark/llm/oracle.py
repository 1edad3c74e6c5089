"""SQL for DuckDB, written from the definitions, of the operators that SQL can express."""

from __future__ import annotations

from tidemark.llm.archive import OP4_SQL
from tidemark.llm.prefixes import OP12_SQL

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

# Windows of items are joined to all runs of as many document words; neighbours on one diagonal make a longer match.
OP1_SQL = f"""
WITH d AS (SELECT doc_id, {WORDS} AS ws FROM documents),
b AS (SELECT item_id, {WORDS} AS ws FROM benchmark),
bw AS (SELECT item_id, j, k, ws[j:j + k - 1] AS win
  FROM (SELECT item_id, ws, least(10, len(ws)) AS k, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS j FROM b WHERE len(ws) > 0)),
dw AS (SELECT doc_id, i, k, ws[i:i + k - 1] AS win
  FROM (SELECT doc_id, ws, k, unnest(range(1, greatest(len(ws) - k + 2, 1))) AS i FROM d, (SELECT DISTINCT k FROM bw))),
h AS (SELECT doc_id, item_id, i, j, k FROM dw JOIN bw USING (k, win)),
p AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS pos FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id),
r AS (SELECT doc_id, max(n + k - 1) AS longest FROM (SELECT doc_id, k, count(*) AS n
    FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, item_id, i - j ORDER BY i) AS island FROM h)
    GROUP BY doc_id, item_id, i - j, island, k) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, CAST(coalesce(longest, 0) AS BIGINT) AS longest
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN t USING (doc_id) LEFT JOIN r USING (doc_id)"""

# Shingles are joined with themselves; links are followed from every document.
OP2_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, ws[i:i + least(5, len(ws)) - 1] AS shingle
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - least(5, len(ws)) + 2)) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM o JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * shared >= 80 * (p.size + q.size - shared)),
c AS (SELECT doc_id AS node, doc_id AS reached FROM d UNION SELECT c.node, l.b FROM c JOIN l ON l.a = c.reached)
SELECT d.doc_id, coalesce(any_value(n.size), 0) AS n_shingles, min(c.reached) AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN c ON c.node = d.doc_id GROUP BY d.doc_id"""

ORACLE = {"op1_benchmark_decontamination": OP1_SQL, "op2_ngram_jaccard": OP2_SQL, "op4_content_archive": OP4_SQL, "op12_conversation_trie": OP12_SQL}
