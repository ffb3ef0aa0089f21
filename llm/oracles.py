"""SQL of the operators that plain SQL can express, for documents with distinct ids."""

from __future__ import annotations

# A string is named by the 128-bit MD5 of its bytes. A run of removed bytes ends 400 bytes after its last start.
BYTE_REPEATS = r"""
WITH docs AS (SELECT doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
starts AS (SELECT doc_id, b, unnest(range(1, n - 398)) AS i FROM docs WHERE n >= 400),
named AS (SELECT doc_id, i, md5(b[i:i + 399]) AS h FROM starts),
repeated AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY h) AS c FROM named) WHERE c > 1),
marked AS (SELECT doc_id, i, coalesce(i > lag(i) OVER w + 400, true) AS opens FROM repeated WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
dealt AS (SELECT doc_id, i, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM marked),
spans AS (SELECT doc_id, min(i) AS lo, max(i) + 399 AS hi FROM dealt GROUP BY doc_id, span),
pieces AS (SELECT s.doc_id, s.lo, d.b[coalesce(lag(s.hi) OVER (PARTITION BY s.doc_id ORDER BY s.lo), 0) + 1:s.lo - 1] AS piece FROM spans s JOIN docs d USING (doc_id)
    UNION ALL SELECT d.doc_id, d.n + 1, d.b[coalesce(e.hi, 0) + 1:d.n] FROM docs d LEFT JOIN (SELECT doc_id, max(hi) AS hi FROM spans GROUP BY doc_id) e USING (doc_id)),
whole AS (SELECT doc_id, sha256(unhex(string_agg(hex(piece), '' ORDER BY lo))) AS kept_sha256 FROM pieces GROUP BY doc_id),
cut AS (SELECT doc_id, sum(hi - lo + 1) AS removed, count(*) AS spans FROM spans GROUP BY doc_id)
SELECT d.doc_id, d.n::BIGINT AS n_bytes, coalesce(c.removed, 0)::BIGINT AS n_removed, coalesce(c.spans, 0)::BIGINT AS n_spans, w.kept_sha256
FROM docs d JOIN whole w USING (doc_id) LEFT JOIN cut c USING (doc_id)
"""

WORD_REPEATS = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM docs),
strings AS (SELECT doc_id, i, count(*) OVER v AS n, string_agg(word, ' ') OVER v AS s FROM words
    WINDOW v AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
numbered AS (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS nth FROM strings WHERE n = 20),
covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM numbered WHERE nth > 1)
SELECT d.doc_id, count(w.i) AS n_words, count(c.i) AS n_removed,
    sha256(coalesce(string_agg(w.word, ' ' ORDER BY w.i) FILTER (WHERE c.i IS NULL), '')) AS kept_sha256
FROM docs d LEFT JOIN words w ON w.doc_id = d.doc_id LEFT JOIN covered c ON c.doc_id = w.doc_id AND c.i = w.i
GROUP BY d.doc_id
"""

COSINE_LINKS = """
WITH RECURSIVE vectors AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
sound AS (SELECT vec_id, v FROM vectors WHERE v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_sum(list_transform(v, lambda x: x * x)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
reached(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b),
least_of AS (SELECT a, min(b) AS b FROM reached GROUP BY a),
degrees AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(m.b, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(m.b, vec_id)) AS kept
FROM vectors LEFT JOIN least_of m ON m.a = vec_id LEFT JOIN degrees d ON d.a = vec_id
"""
