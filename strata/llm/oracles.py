"""DuckDB SQL for the queries that SQL can express."""

WORDS = r"[x FOR x IN regexp_split_to_array({text}, '[\x20\x09-\x0D]+') IF x <> '']"

NEAR_DUPLICATES = f"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS.format(text="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE list_distinct([array_to_string(w[i:i+3], ' ') FOR i IN range(1, len(w) - 2)]) END AS s FROM w),
n AS (SELECT doc_id, len(s) AS n FROM s),
u AS (SELECT doc_id, unnest(s) AS g FROM s),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM u a JOIN u b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
r AS (SELECT doc_id AS x, doc_id AS root FROM n UNION SELECT l.y, r.root FROM r JOIN l ON l.x = r.x WHERE r.root < l.y),
t AS (SELECT x, min(root) AS root FROM r GROUP BY x)
SELECT doc_id, n AS n_shingles, root AS component_id, doc_id = root AS kept FROM n JOIN t ON x = doc_id
"""

REPEATED_WORDS = f"""
WITH w AS (SELECT doc_id, {WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(w) - 18)) AS i, w FROM w WHERE len(w) >= 20),
g AS (SELECT doc_id, i, md5(array_to_string(w[i:i+19], ' ')) AS g FROM p),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS nth FROM g),
b AS (SELECT doc_id, list(i) AS at FROM f WHERE nth > 1 GROUP BY doc_id),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM f WHERE nth > 1),
x AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM w),
k AS (SELECT x.doc_id, string_agg(word, ' ' ORDER BY x.i) FILTER (c.i IS NULL) AS kept, count(c.i) AS gone FROM x LEFT JOIN c USING (doc_id, i) GROUP BY x.doc_id)
SELECT w.doc_id, len(w) AS n_words, coalesce(gone, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN k USING (doc_id)
"""

REPEATED_BYTES = """
WITH h AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT doc_id, unnest(range(0, len(h) // 2 - 99)) AS i, h FROM h WHERE len(h) >= 200),
g AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 200)) AS g FROM p),
f AS (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS nth FROM g),
d AS (SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS step FROM f WHERE nth > 1),
q AS (SELECT doc_id, i, sum(CASE WHEN step <= 100 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM d),
r AS (SELECT doc_id, run, min(i) AS s, max(i) + 100 AS e FROM q GROUP BY ALL),
v AS (SELECT doc_id, s, e, lag(e, 1, 0) OVER (PARTITION BY doc_id ORDER BY s) AS b FROM r),
k AS (SELECT doc_id, string_agg(substr(h, 2 * b + 1, 2 * (s - b)), '' ORDER BY s) AS front, max(e) AS e, sum(e - s) AS gone, count(*) AS runs FROM v JOIN h USING (doc_id) GROUP BY doc_id)
SELECT h.doc_id, len(h) // 2 AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, coalesce(runs, 0) AS n_spans,
 sha256(unhex(CASE WHEN gone IS NULL THEN h ELSE front || substr(h, 2 * e + 1) END)) AS kept_sha256 FROM h LEFT JOIN k USING (doc_id)
"""
