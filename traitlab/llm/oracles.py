"""DuckDB SQL twins of the queries that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

OP2 = rf"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
        ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END AS sh FROM w),
n AS (SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles FROM s),
e AS (SELECT doc_id, hash(unnest(sh)) AS g FROM s),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM e x JOIN e y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * i >= 90 * (na.n_shingles + nb.n_shingles - i)),
r(a, b) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT n.doc_id, n.n_shingles, min(r.b) AS component_id FROM n JOIN r ON r.a = n.doc_id GROUP BY 1, 2
"""

OP4 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, {_WORDS.format('text')} AS ws FROM d),
win AS (SELECT rid, unnest(range(1, len(ws) - 6)) AS i, unnest(list_transform(range(1, len(ws) - 6), lambda i: array_to_string(ws[i:i + 7], ' '))) AS x FROM w WHERE len(ws) >= 8),
rep AS (SELECT rid, i FROM win QUALIFY count(*) OVER (PARTITION BY rid, x) > 1),
cov AS (SELECT rid, count(DISTINCT i + k) AS n_repeat_words FROM rep, range(0, 8) AS t(k) GROUP BY rid),
top AS (SELECT rid, max(c) AS c FROM (SELECT rid, x, count(*) AS c FROM (SELECT rid, unnest(ws) AS x FROM w) GROUP BY 1, 2) GROUP BY 1),
ln AS (SELECT rid, list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls FROM d),
f AS (SELECT d.doc_id, d.text, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, len(ls) AS n_lines,
        CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, coalesce(top.c, 0) AS top,
        len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) AS stutter,
        length(regexp_replace(text, '[^A-Z]', '', 'g')) AS up, length(regexp_replace(text, '[^a-z]', '', 'g')) AS low, length(regexp_replace(text, '[^!]', '', 'g')) AS ex
      FROM d JOIN w USING (rid) JOIN ln USING (rid) LEFT JOIN cov USING (rid) LEFT JOIN top USING (rid)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > 3 * n_words OR 2 * n_dup_lines > n_lines OR word_chars < 2 * n_words OR word_chars > 25 * n_words
       OR 10 * up > 6 * (up + low) OR 2 * ex > n_words OR 4 * top > n_words OR 10 * stutter > 3 * n_words) AS kept
FROM b
"""

OP5 = rf"""
WITH w AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(ws) - 18)) AS i, unnest(list_transform(range(1, len(ws) - 18), lambda i: array_to_string(ws[i:i + 19], ' '))) AS x FROM w WHERE len(ws) >= 20),
rep AS (SELECT doc_id, i FROM win QUALIFY row_number() OVER (PARTITION BY x ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM rep, range(0, 20) AS t(k)),
word AS (SELECT doc_id, unnest(range(1, len(ws) + 1)) AS i, unnest(ws) AS x FROM w),
kept AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY i) AS t FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY 1)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

OP9 = """
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS x FROM embeddings),
ok AS (SELECT * FROM v WHERE label IS NOT NULL AND x IS NOT NULL AND len(list_filter(x, lambda z: z IS NULL OR NOT isfinite(z))) = 0 AND len(list_filter(x, lambda z: z <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND len(a.x) = len(b.x) AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.x, b.x) >= 0.98),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a),
r(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT v.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v JOIN c ON c.a = v.vec_id LEFT JOIN n ON n.a = v.vec_id
"""

SQL = {"op2_ngram_jaccard_join": OP2, "op4_quality_rules": OP4, "op5_substring_dedup": OP5, "op9_embedding_near_dedup": OP9}
