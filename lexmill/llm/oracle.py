"""DuckDB SQL with the same rows as the queries, where SQL can say it."""

WORDS = r"list_filter(regexp_split_to_array({0}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"

OP6 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS g FROM w
), e AS (SELECT doc_id, len(g) AS n, unnest(g) AS g FROM s
), o AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), l AS (SELECT a, b FROM o WHERE 100 * c >= 70 * (na + nb - c)
), r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a
), d AS (SELECT a, count(*) AS k FROM l GROUP BY a
), c AS (SELECT a, min(b) AS m FROM r GROUP BY a)
SELECT s.doc_id, len(g)::BIGINT AS n_shingles, coalesce(k, 0)::BIGINT AS n_similar, m AS component_id
FROM s LEFT JOIN d ON d.a = s.doc_id LEFT JOIN c ON c.a = s.doc_id
"""

OP10 = r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS x FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY x) AS keep_id, count(*) OVER (PARTITION BY x) AS group_size, doc_id = min(doc_id) OVER (PARTITION BY x) AS kept, h AS text_sha256 FROM t
"""

OP7 = r"""
WITH w AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents
), g AS (SELECT r, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS g, unnest(range(1, len(w) - 1)) AS p FROM w WHERE len(w) > 2
), twin AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, g) AS c FROM g) WHERE c > 1
), cov AS (SELECT r, count(DISTINCT p + k) AS n FROM twin, (VALUES (0), (1), (2)) AS k(k) GROUP BY r
), u AS (SELECT DISTINCT r, unnest(l) AS x FROM w
), m AS (SELECT r, x, len(list_filter(regexp_split_to_array(x, '[\x20\x09-\x0D]+'), lambda v: v <> '')) AS n,
    length(x) - length(regexp_replace(x, '[!?#*$%&<>]', '', 'g')) AS marks, length(x) - length(regexp_replace(x, '[|\x{bb}\x{2022}\x{b7}>]', '', 'g')) AS menu FROM u
), good AS (SELECT r, sum(n) AS n FROM m
  WHERE (regexp_matches(x, '@END@') OR n > 4) AND marks < 0.8 * n AND NOT (menu >= 3 AND menu >= 0.25 * n) AND NOT regexp_matches(x, '@BOILER@') GROUP BY r
), b AS (
  SELECT w.r, doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
    coalesce(cov.n, 0)::BIGINT AS n_repeat_words, coalesce(good.n, 0)::BIGINT AS n_left_words
  FROM w LEFT JOIN cov ON cov.r = w.r LEFT JOIN good ON good.r = w.r
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_left_words >= 0.5 * n_words AS kept, n_left_words FROM b
"""

OP1 = r"""
WITH d AS (
  SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))::BIGINT AS size,
    (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u FROM documents
), q AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1.0::DOUBLE ELSE 0.25::DOUBLE END) AS weight FROM labels WHERE quality IS NOT NULL GROUP BY doc_id
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, ([1, 2, 3])[((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::INT] AS w FROM d GROUP BY source
), o AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / w::DOUBLE, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining,
    sum(w) OVER (ORDER BY 3 * source_size / w::DOUBLE, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight FROM s
), l AS (SELECT remaining::DOUBLE / open_weight::DOUBLE AS level FROM o WHERE remaining::DOUBLE / open_weight::DOUBLE <= 3 * source_size / w::DOUBLE ORDER BY 3 * source_size / w::DOUBLE, source LIMIT 1
), t AS (SELECT source, source_size, least((SELECT level FROM l) * w, (3 * source_size)::DOUBLE) AS target FROM s
), p AS (
  SELECT d.doc_id, d.size, d.source, source_size, target,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY -ln(u) / coalesce(weight, 0.5::DOUBLE), d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN q ON q.doc_id = d.doc_id
), e AS (SELECT *, floor(target + 0.5)::BIGINT AS whole, CASE WHEN source_size > 0 THEN floor(target + 0.5)::BIGINT // source_size ELSE 0 END AS epochs FROM p)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, whole - epochs * source_size - before)))::BIGINT AS taken, source FROM e
"""
