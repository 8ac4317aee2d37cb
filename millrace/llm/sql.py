"""DuckDB SQL for the queries of ``queries.py`` that SQL can express, written from their contracts."""

NORMAL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

EXACT_DEDUP = f"""
WITH d AS (SELECT doc_id, {NORMAL} AS t FROM documents)
SELECT doc_id,
       max(doc_id) OVER w AS keep_id,
       count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept,
       sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, strlen(h) AS n, sha256(h) AS d, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM q
"""

SUBSTRING_DEDUP = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), words AS (
    SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d
), runs AS (
    SELECT doc_id, p AS i, string_agg(word, ' ') OVER t AS run, count(*) OVER t AS n
    FROM words WINDOW t AS (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)
), win AS (
    SELECT doc_id, i, min(doc_id) OVER (PARTITION BY run) AS first FROM runs WHERE n = 13
), gone AS (
    SELECT DISTINCT doc_id, i + unnest(range(0, 13)) AS p FROM win WHERE first < doc_id
), kept AS (
    SELECT words.doc_id, count(*) AS n, count(gone.p) AS r, string_agg(word, ' ' ORDER BY words.p) FILTER (gone.p IS NULL) AS k
    FROM words LEFT JOIN gone ON gone.doc_id = words.doc_id AND gone.p = words.p GROUP BY words.doc_id
)
SELECT d.doc_id, coalesce(n, 0) AS n_words, coalesce(r, 0) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256 FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id
"""


MINHASH = rf"""
WITH RECURSIVE d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({NORMAL}, '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
    SELECT r, doc_id, list_distinct(list_transform(range(1, greatest(1, len(w) - 4) + 1), lambda i: array_to_string(w[i : i + 4], ' '))) AS own FROM d WHERE len(w) > 0
), sets AS (
    SELECT list_sort(own) AS own, len(own) AS n, min(doc_id) AS first, row_number() OVER () AS k FROM s GROUP BY ALL
), shingles AS (
    SELECT k, n, unnest(own) AS g FROM sets
), links AS (
    SELECT a.k AS u, b.k AS v FROM shingles a JOIN shingles b ON a.g = b.g AND a.k <> b.k
    GROUP BY a.k, b.k, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reached AS (
    SELECT k AS u, k AS v FROM sets UNION SELECT reached.u, links.v FROM reached JOIN links ON links.u = reached.v
), component AS (
    SELECT reached.u AS k, min(first) AS component_id FROM reached JOIN sets ON sets.k = reached.v GROUP BY reached.u
), found AS (
    SELECT s.r, n, component_id FROM s JOIN sets ON list_sort(s.own) = sets.own JOIN component USING (k)
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, CASE WHEN n IS NULL THEN d.doc_id ELSE component_id END AS component_id,
       coalesce(d.doc_id = CASE WHEN n IS NULL THEN d.doc_id ELSE component_id END, false) AS kept
FROM d LEFT JOIN found ON found.r = d.r
"""

HARD_NEGATIVES = """
WITH v AS (
    SELECT row_number() OVER () AS n, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND coalesce(list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))), true)
), scored AS (
    SELECT a.n AS an, b.n AS bn, a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
           list_sum(list_transform(range(1, len(a.e) + 1), lambda i: a.e[i] * b.e[i]))::BIGINT AS score
    FROM v a JOIN v b ON a.n <> b.n WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT an, bn, anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY an ORDER BY score DESC, other_id NULLS LAST) <= 5
)
SELECT p.anchor_id, positive_id, row_number() OVER w AS rank, other_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON s.an = p.an AND NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW w AS (PARTITION BY p.an, p.bn ORDER BY score DESC, other_id NULLS LAST)
QUALIFY row_number() OVER w <= 5
"""


def all_sql() -> dict[str, str]:
    return {"op4_exact_dedup": EXACT_DEDUP, "op5_warc": WARC, "op6_substring_dedup": SUBSTRING_DEDUP, "op11_minhash": MINHASH, "op12_hard_negatives": HARD_NEGATIVES}
