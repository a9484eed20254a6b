"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

# Hosts, paths and rules as the contract of the query states them.
URL_FILTERS = r"""
WITH parts AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), rules(verdict, rule_host, rule_path) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
         ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), judged AS (
  SELECT parts.*, (
    SELECT max(struct_pack(n := length(rule_host || rule_path), rule := rule_host || rule_path, verdict := verdict))
    FROM rules
    WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS best
  FROM parts
)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict FROM judged
"""

QUALITY_RULES = r"""
WITH split AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), lines AS (
  SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM split)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
), windows AS (
  SELECT r, i, array_to_string(w[i:i + 7], ' ') AS k
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 6, 1))) AS i FROM split)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT r, count(DISTINCT place) AS n_repeat_words
  FROM (SELECT r, unnest(range(i, i + 8)) AS place FROM twice) GROUP BY r
), base AS (
  SELECT r, doc_id, source, len(w) AS n_words,
         length(array_to_string(w, '')) AS word_chars,
         length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM split LEFT JOIN lines USING (r) LEFT JOIN covered USING (r)
), failing AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         base_failed OR 10 * n_symbols > 3 * word_chars OR 2 * n_dup_lines > n_words AS failed
  FROM base
), hosts AS (
  SELECT source, count(*) AS n, count(*) FILTER (failed) AS k FROM failing GROUP BY source
), moments AS (
  SELECT sum(k) / sum(n) AS m, sum((k / n) * (k / n) * n) / sum(n) - (sum(k) / sum(n)) * (sum(k) / sum(n)) AS spread
  FROM hosts
), prior AS (
  SELECT m, CASE WHEN spread > 1e-12 THEN least(greatest(m * (1 - m) / spread - 1, 1.0), 10000.0) ELSE 10000.0 END AS s
  FROM moments
), rates AS (
  SELECT source, (k + m * s) / (n + s) AS rate FROM hosts, prior
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND rate <= 0.5 AS kept
FROM failing LEFT JOIN rates ON failing.source IS NOT DISTINCT FROM rates.source
"""

DECONTAMINATION = r"""
WITH items AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), item_windows AS (
  SELECT DISTINCT item, l, array_to_string(w[i:i + l - 1], ' ') AS k
  FROM (SELECT item, w, least(len(w), 10) AS l, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i
        FROM items WHERE len(w) > 0)
), docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), doc_windows AS (
  SELECT r, l, i, array_to_string(w[i:i + l - 1], ' ') AS k
  FROM (SELECT r, w, l, unnest(range(1, len(w) - l + 2)) AS i
        FROM docs, (SELECT DISTINCT l FROM item_windows) WHERE len(w) >= l)
), hits AS (
  SELECT r, l, i, item FROM doc_windows JOIN item_windows USING (l, k)
), covered AS (
  SELECT r, count(DISTINCT place) AS n_hit
  FROM (SELECT r, unnest(range(i, i + l)) AS place FROM (SELECT DISTINCT r, i, l FROM hits)) GROUP BY r
), found AS (
  SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS item_ids FROM hits GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(item_ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (r) LEFT JOIN found USING (r)
"""

# Pairs by way of shared shingles of SIZE words, components by the smallest label that reaches a document.
LINKED = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, hash(array_to_string(w[i:i + SIZE - 1], ' ')) AS k
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - SIZE + 1, 1) + 1)) AS i FROM docs WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
  FROM shingles a JOIN shingles b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM pairs JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
  WHERE 100 * common >= 80 * (a.n + b.n - common)
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
), parts AS (
  SELECT x, min(y) AS component_id FROM reach GROUP BY x
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents JOIN parts ON parts.x = doc_id LEFT JOIN sizes USING (doc_id)
"""

NEAR_DUPLICATES = f"SELECT *, doc_id = component_id AS kept FROM ({LINKED.replace('SIZE', '4')})"
JACCARD_JOIN = LINKED.replace("SIZE", "5")

# Bytes as pairs of hexadecimal digits. A window that starts at i covers bytes i to i + 49; covers that touch are one run.
REPEATED_STRINGS = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS d, hex(encode(coalesce(text, ''))) AS h
  FROM documents
), windows AS (
  SELECT r, d, i, substr(h, 2 * i + 1, 100) AS k
  FROM (SELECT r, d, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM docs WHERE length(h) >= 100)
), firsts AS (
  SELECT k, min(d) AS owner FROM windows GROUP BY k
), gone AS (
  SELECT r, i, coalesce(i - lag(i) OVER (PARTITION BY r ORDER BY i), 51) AS step
  FROM windows JOIN firsts USING (k) WHERE owner < d
), runs AS (
  SELECT r, min(i) AS a, max(i) + 50 AS b
  FROM (SELECT *, sum(CAST(step > 50 AS INTEGER)) OVER (PARTITION BY r ORDER BY i) AS run FROM gone) GROUP BY r, run
), pieces AS (
  SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS after FROM runs
), found AS (
  SELECT r, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last,
         string_agg(substr(h, 2 * after + 1, 2 * (a - after)), '' ORDER BY a) AS kept
  FROM pieces JOIN docs USING (r) GROUP BY r
)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM docs LEFT JOIN found USING (r)
"""

RANKED_SEARCH = r"""
WITH items AS (
  SELECT DISTINCT item_id,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), stats AS (
  SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS n_terms FROM docs WHERE len(w) > 0
), postings AS (
  SELECT r, term, count(*) AS tf
  FROM (SELECT r, unnest(w) AS term FROM docs) WHERE term IN (SELECT term FROM items) GROUP BY r, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
  FROM postings, stats GROUP BY term, n_docs
), sizes AS (
  SELECT r, doc_id, 100 - 50 + ((50 * len(w)::BIGINT * n_docs) // n_terms) AS m FROM docs, stats WHERE len(w) > 0
), scores AS (
  SELECT item_id, r, sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM items JOIN weights USING (term) JOIN postings USING (term) JOIN sizes USING (r) GROUP BY item_id, r
), ranked AS (
  SELECT item_id, doc_id, score,
         row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST)::INTEGER AS rank
  FROM scores JOIN sizes USING (r) WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""

ORACLES = {
    "op2_suffix_array_dedup": REPEATED_STRINGS,
    "op10_minhash_near_dedup": NEAR_DUPLICATES,
    "op6_benchmark_decontamination": DECONTAMINATION,
    "op5_url_filters": URL_FILTERS,
    "op7_quality_rules": QUALITY_RULES,
    "op11_ngram_jaccard_join": JACCARD_JOIN,
    "op13_ranked_search": RANKED_SEARCH,
}
