"""DuckDB SQL of the queries that SQL can express over whole tables.

The rest is held against brute force in the tests: op6 (template windows), op7 (CRC32 is no
DuckDB function), op9 and op1, op2 (trained models), op4 (edit distance inside texts), op10
(lattice search), op11 (digests), op12 (eigenvectors), op13 (CRC32, and every period of whole texts).
"""

from __future__ import annotations

LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3 = f"""WITH d AS (SELECT doc_id, {LOW} AS content FROM documents),
  g AS (SELECT content, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(content) AS text_sha256 FROM d JOIN g USING (content)"""

OP5 = f"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array({LOW}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM documents),
  s AS (SELECT DISTINCT doc_id, CASE WHEN len(words) < 5 THEN array_to_string(words, ' ') ELSE array_to_string(words[i:i + 4], ' ') END AS sh
    FROM w, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS u(i) WHERE len(words) > 0),
  n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
  p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
  e AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * k >= 75 * (x.n + y.n - k)),
  r(id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.id, e.b FROM r JOIN e ON r.other = e.a)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id FROM documents LEFT JOIN n USING (doc_id) JOIN r ON id = doc_id GROUP BY doc_id"""

OP8 = """WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
  g AS (SELECT doc_id, i AS start, md5_number(substr(h, 2 * i + 1, 200)) AS m FROM d, unnest(range(0, greatest(len(h) // 2 - 99, 0))) AS u(i)),
  k AS (SELECT doc_id, start, row_number() OVER (PARTITION BY m ORDER BY doc_id, start) AS nth FROM g),
  c AS (SELECT doc_id, start, start + 100 AS stop, max(start + 100) OVER (PARTITION BY doc_id ORDER BY start ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM k WHERE nth > 1),
  f AS (SELECT *, sum(CASE WHEN reach IS NULL OR start > reach THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY start) AS span FROM c),
  s AS (SELECT doc_id, span, min(start) AS a, max(stop) AS b FROM f GROUP BY 1, 2),
  gap AS (SELECT doc_id, b AS a, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS b FROM s UNION ALL SELECT doc_id, 0, min(a) FROM s GROUP BY 1),
  kept AS (SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (coalesce(b, len(h) // 2) - a)), '' ORDER BY a) AS h FROM gap JOIN d USING (doc_id) GROUP BY 1),
  t AS (SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans FROM s GROUP BY 1)
SELECT doc_id, (len(d.h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id) LEFT JOIN kept USING (doc_id)"""

ORACLES = {"op3_exact_dedup": OP3, "op5_ngram_join": OP5, "op8_suffix_dedup": OP8}
