"""DuckDB SQL of the registered operator queries, written apart from the operators."""

WORDS = r"list_filter(string_split_regex({text}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

OP3 = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, {WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
lines AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
grams AS (SELECT doc_id, list_transform(generate_series(1, len(w) - 2), lambda i: w[i] || chr(10) || w[i + 1] || chr(10) || w[i + 2]) AS g, w FROM d),
pos AS (SELECT doc_id, unnest(g) AS gram, unnest(generate_series(1, len(g))) AS i FROM grams WHERE len(w) >= 3),
twice AS (SELECT doc_id, gram FROM pos GROUP BY ALL HAVING count(*) > 1),
hit AS (SELECT DISTINCT doc_id, i + j AS p FROM pos SEMI JOIN twice USING (doc_id, gram), (VALUES (0), (1), (2)) v(j)),
rep AS (SELECT doc_id, count(*) AS n FROM hit GROUP BY doc_id),
m AS (
  SELECT d.doc_id, d.source, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM d JOIN lines USING (doc_id) LEFT JOIN rep USING (doc_id)),
f AS (
  SELECT *, 100 * n_symbols > 30 * n_words AS f1, 100 * n_dup_lines > 30 * n_lines AS f2,
         word_chars < 2 * n_words OR word_chars > 20 * n_words AS f3,
         n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM m),
h AS (SELECT source, count(*) AS n, count(*) FILTER (f1) AS x1, count(*) FILTER (f2) AS x2, count(*) FILTER (f3) AS x3 FROM f GROUP BY source),
p AS (SELECT avg(x1 / n) AS m1, var_pop(x1 / n) AS v1, avg(x2 / n) AS m2, var_pop(x2 / n) AS v2, avg(x3 / n) AS m3, var_pop(x3 / n) AS v3 FROM h),
k AS (SELECT *, CASE WHEN v1 > 0 THEN least(greatest(m1 * (1 - m1) / v1 - 1, 1), 1e4) ELSE 1e4 END AS k1,
             CASE WHEN v2 > 0 THEN least(greatest(m2 * (1 - m2) / v2 - 1, 1), 1e4) ELSE 1e4 END AS k2,
             CASE WHEN v3 > 0 THEN least(greatest(m3 * (1 - m3) / v3 - 1, 1), 1e4) ELSE 1e4 END AS k3 FROM p),
v AS (SELECT source, (x1 + m1 * k1) / (n + k1) > least(0.5::DOUBLE, 1.1::DOUBLE * m1) AS h1, (x2 + m2 * k2) / (n + k2) > least(0.5::DOUBLE, 1.1::DOUBLE * m2) AS h2, (x3 + m3 * k3) / (n + k3) > least(0.5::DOUBLE, 1.1::DOUBLE * m3) AS h3 FROM h, k)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (f1 AND h1 OR f2 AND h2 OR f3 AND h3) AS kept
FROM f JOIN v ON f.source IS NOT DISTINCT FROM v.source
"""

OP2 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, {WORDS.format(text="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
             ELSE list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM d),
x AS MATERIALIZED (SELECT doc_id, len(g) AS n, unnest(g) AS gram FROM s),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c, any_value(a.n) AS na, any_value(b.n) AS nb
          FROM x a JOIN x b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS MATERIALIZED (SELECT a, b FROM pairs WHERE 100 * c >= 75 * (na + nb - c)),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
low AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT s.doc_id, len(g)::BIGINT AS n_shingles, least(s.doc_id, coalesce(m, s.doc_id)) AS component_id,
       least(s.doc_id, coalesce(m, s.doc_id)) = s.doc_id AS kept
FROM s LEFT JOIN low ON s.doc_id = low.a
"""

OP5 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
h AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha1(b) AS x FROM p),
f AS (SELECT x, max(page_id) AS first FROM h GROUP BY x)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (((('0x' || substr(x, (i // 4) * 5 + 1, 5))::INT >> (15 - 5 * (i % 4))) & 31))::INT, 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM h JOIN f USING (x)
"""

HOST = "translate(regexp_extract({u}, '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
PATH = "regexp_extract({u}, '^(?s:.*?)://[^/?#]*([^?#]*)', 1)"
PLAIN = ("CASE WHEN " + HOST + " <> '' THEN '//' || regexp_replace(" + HOST + r", '^(www|m)\.', '') || "
         r"regexp_replace(regexp_replace(" + PATH + r", '\.html?$', ''), '/+$', '') END")
OP6 = rf"""
WITH RECURSIVE u AS (
  SELECT page_id, url, coalesce({HOST.format(u="url")}, '') AS host, coalesce({PATH.format(u="url")}, '') AS path, html FROM pages),
r AS (SELECT *, CASE
    WHEN (host = 'example.net' OR suffix(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR suffix(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM u),
o AS (SELECT *, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' END AS own FROM r),
e AS MATERIALIZED (SELECT DISTINCT url AS a, {PLAIN.format(u="url")} AS b FROM o WHERE host <> ''),
both_ways AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach(a, b) AS (SELECT a, b FROM both_ways UNION SELECT reach.a, x.b FROM reach JOIN both_ways x ON reach.b = x.a),
g AS (SELECT reach.a AS url, bool_or(own = 'block') AS blocked, bool_or(own = 'allow') AS allowed
      FROM reach JOIN o ON reach.b = o.url GROUP BY reach.a)
SELECT page_id, host, path, rule, coalesce(own, CASE WHEN g.blocked AND NOT coalesce(g.allowed, FALSE) THEN 'block' ELSE 'allow' END) AS verdict
FROM o LEFT JOIN g USING (url)
"""

ALNUM = r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
OP8 = rf"""
WITH d AS (SELECT doc_id, {ALNUM} AS w FROM documents),
i AS (SELECT item_id, {ALNUM} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, unnest(list_transform(generate_series(1, greatest(len(w) - 12, 1)), lambda k: array_to_string(w[k:k + 12], ' '))) AS t
        FROM i WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM win),
pos AS (SELECT doc_id, n, unnest(generate_series(1, len(w) - n + 1)) AS k, unnest(list_transform(generate_series(1, len(w) - n + 1), lambda k: array_to_string(w[k:k + n - 1], ' '))) AS t
        FROM d, sizes WHERE len(w) >= n),
hit AS MATERIALIZED (SELECT doc_id, n, k, item_id FROM pos JOIN win USING (n, t)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(k, k + n - 1)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

# Rows with a null or non-finite component take no part; DuckDB's isfinite is false for both kinds.
OP13 = """
WITH v AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda c: floor(256 * c::DOUBLE)::BIGINT) AS x
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND vec_id IS NOT NULL
             AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
                  list_inner_product(a.x::DOUBLE[], b.x::DOUBLE[])::BIGINT AS score
           FROM v a, v b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
n AS (SELECT anchor_id, positive_id, positive_score, other AS negative_id, score AS negative_score,
             (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other))::INTEGER AS rank
      FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""

ORACLES = {"op2_minhash_near_dedup": OP2, "op3_quality_rules": OP3, "op5_warc": OP5, "op6_url_filter": OP6, "op8_decontamination": OP8, "op13_hard_negatives": OP13}
