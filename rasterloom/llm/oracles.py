"""DuckDB statements of the operators that SQL can express."""

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _lower(column):
    return f"translate(coalesce({column}, ''), '{UPPER}', '{UPPER.lower()}')"


PLAIN = r"'[^\x20\x09-\x0D]+'"
ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

TOP_K = """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
               WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.e, v.e) AS BIGINT) AS score
          FROM v q JOIN v ON v.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0)
    SELECT query_id, CAST(k AS INTEGER) AS rank, vec_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k FROM s) WHERE k <= 20"""

CONTAMINATION = f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_lower('text')}, {ALNUM}) AS w FROM documents),
    i AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all({_lower('text')}, {ALNUM}) AS w FROM benchmark),
    iw AS (SELECT DISTINCT item, n, w[p:p + n - 1] AS win
           FROM (SELECT item, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM i WHERE len(w) > 0)),
    dw AS (SELECT r, n, p, w[p:p + n - 1] AS win
           FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d CROSS JOIN (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
    hits AS (SELECT r, p, n, item FROM dw JOIN iw USING (n, win)),
    words AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM hits) GROUP BY r),
    items AS (SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS h FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(h, sha256('')) AS items_sha256,
           n_hit IS NOT NULL AS contaminated
    FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)"""

REPEATED = f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), {PLAIN}) AS w FROM documents),
    s AS (SELECT r, p, w[p:p + 34] AS win FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS p FROM d WHERE len(w) >= 35)),
    again AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY win) AS n FROM s) WHERE n > 1),
    gone AS (SELECT DISTINCT r, unnest(range(p, p + 35)) AS q FROM again),
    words AS (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS q FROM d),
    kept AS (SELECT r, string_agg(x, ' ' ORDER BY q) AS body FROM words ANTI JOIN gone USING (r, q) GROUP BY r),
    lost AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
    SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
    FROM d LEFT JOIN kept USING (r) LEFT JOIN lost USING (r)"""

JACCARD = f"""
    WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_lower('text')}, {PLAIN}) AS w FROM documents),
    s AS (SELECT DISTINCT r, w[p:p + 3] AS x FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 2, 2))) AS p FROM d WHERE len(w) > 0)),
    n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
    c AS (SELECT a.r AS a, b.r AS b, count(*) AS k FROM s a JOIN s b ON a.x = b.x AND a.r <> b.r GROUP BY ALL),
    e AS (SELECT a, b FROM c JOIN n na ON na.r = a JOIN n nb ON nb.r = b WHERE 100 * k >= 85 * (na.n + nb.n - k)),
    reach AS (SELECT r AS a, r AS b FROM d UNION SELECT reach.a, e.b FROM reach JOIN e ON e.a = reach.b)
    SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id
    FROM d LEFT JOIN n USING (r) JOIN (SELECT reach.a AS r, min(o.doc_id) AS component_id FROM reach JOIN d o ON o.r = reach.b GROUP BY reach.a) m USING (r)"""

ORACLES = {"op1_exact_topk": TOP_K, "op4_decontamination": CONTAMINATION, "op6_substring_dedup": REPEATED, "op9_jaccard_join": JACCARD}
