"""DuckDB forms of the queries that SQL can express."""

MIX_SQL = r"""
WITH sized AS (
 SELECT doc_id, COALESCE('s' || source, '~') AS src,
  COALESCE(LEN(REGEXP_EXTRACT_ALL(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
  MD5('mix:' || COALESCE(CAST(doc_id AS VARCHAR), '-')) AS key
 FROM documents
), sources AS (
 SELECT src, SUM(size)::BIGINT AS source_size FROM sized GROUP BY src
), weighted AS (
 SELECT *, [3.0, 1.0, 2.0][((ROW_NUMBER() OVER (ORDER BY src) - 1) % 3 + 1)::INT]::DOUBLE AS weight,
  (source_size * 2)::DOUBLE AS most, 1.5::DOUBLE * (SUM(source_size) OVER ())::DOUBLE AS budget
 FROM sources
), levels AS (
 SELECT *, most / weight AS full_at,
  (budget - COALESCE(SUM(most) OVER (ORDER BY most / weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
  / SUM(weight) OVER (ORDER BY most / weight, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
 FROM weighted
), targets AS (
 SELECT src, source_size, budget,
  LEAST(most, (SELECT ARG_MIN(level, (full_at, src)) FROM levels WHERE level <= full_at) * weight) AS target
 FROM levels
), queued AS (
 SELECT s.*, t.source_size, t.target, t.budget,
  SUM(size) OVER (PARTITION BY s.src ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS until
 FROM sized s JOIN targets t ON s.src = t.src
), turns AS (
 SELECT *, (until + turn * source_size)::DOUBLE / target AS finish FROM queued, (VALUES (0), (1)) AS r(turn) WHERE size > 0
), filled AS (
 SELECT doc_id, size, SUM(size) OVER (ORDER BY finish, src, key ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) <= budget AS fits
 FROM turns
), taken AS (
 SELECT doc_id, SUM(size) AS taken FROM filled WHERE fits GROUP BY doc_id
)
SELECT q.doc_id, q.size, q.source_size, q.target, COALESCE(t.taken, 0)::BIGINT AS taken
FROM queued q LEFT JOIN taken t ON q.doc_id IS NOT DISTINCT FROM t.doc_id
"""

HOST_RULES_SQL = r"""
WITH worded AS (
 SELECT doc_id, source, COALESCE(text, '') AS text, REGEXP_EXTRACT_ALL(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
 SELECT doc_id, i, words[i:i + 4] AS w5 FROM (
  SELECT doc_id, words, UNNEST(RANGE(1, LEN(words) - 3)) AS i FROM worded)
), counted AS (
 SELECT doc_id, i, COUNT(*) OVER (PARTITION BY doc_id, w5) AS n FROM windows
), repeats AS (
 SELECT doc_id, COUNT(DISTINCT pos) AS n_repeat_words FROM (
  SELECT doc_id, UNNEST([i, i + 1, i + 2, i + 3, i + 4]) AS pos FROM counted WHERE n > 1) GROUP BY doc_id
), lines AS (
 SELECT doc_id, COUNT(*) - COUNT(DISTINCT line) AS n_dup_lines FROM (
  SELECT doc_id, UNNEST(STRING_SPLIT(text, chr(10))) AS line FROM worded)
 WHERE REGEXP_MATCHES(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), measured AS (
 SELECT w.doc_id, w.source, LEN(words)::BIGINT AS n_words,
  COALESCE(LIST_SUM(LIST_TRANSFORM(words, lambda x: LENGTH(x))), 0)::BIGINT AS word_chars,
  LENGTH(REGEXP_REPLACE(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
  COALESCE(n_dup_lines, 0)::BIGINT AS n_dup_lines, COALESCE(n_repeat_words, 0)::BIGINT AS n_repeat_words
 FROM worded w LEFT JOIN repeats r ON w.doc_id = r.doc_id LEFT JOIN lines l ON w.doc_id = l.doc_id
), failing AS (
 SELECT *, (n_words < 10)::INT AS f1, (100 * n_repeat_words > 20 * n_words)::INT AS f2, (10 * n_symbols > n_words)::INT AS f3,
  (n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words))::INT AS f4,
  (n_dup_lines >= 3 AND 10 * n_dup_lines > n_words)::INT AS f5 FROM measured
), rates AS (
 SELECT source, rule, COUNT(*) AS n, SUM(failed) AS k, SUM(failed) / COUNT(*)::DOUBLE AS rate
 FROM (UNPIVOT failing ON f1, f2, f3, f4, f5 INTO NAME rule VALUE failed) GROUP BY source, rule
), priors AS (
 SELECT rule, AVG(rate) AS m, COALESCE(VAR_SAMP(rate), 0) AS v FROM rates GROUP BY rule
), strengths AS (
 SELECT rule, m, CASE WHEN v > 0 THEN LEAST(GREATEST(m * (1 - m) / v - 1, 1.0), 1e4) ELSE 1e4 END AS s FROM priors
), verdicts AS (
 SELECT source, MAX(n) AS host_docs, BOOL_OR((k + m * s) / (n + s) > 0.5) AS host_rejected
 FROM rates JOIN strengths USING (rule) GROUP BY source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f1 + f2 > 0 AS base_failed,
 f1 + f2 = 0 AND NOT host_rejected AS kept, host_docs, host_rejected
FROM failing f JOIN verdicts v ON f.source IS NOT DISTINCT FROM v.source
"""

LEXICAL_SEARCH_SQL = r"""
WITH doc_terms AS (
 SELECT doc_id, UNNEST(REGEXP_EXTRACT_ALL(TRANSLATE(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), item_terms AS (
 SELECT item_id, term, COUNT(*) AS times FROM (
  SELECT item_id, UNNEST(REGEXP_EXTRACT_ALL(TRANSLATE(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY item_id, term
), sizes AS (
 SELECT doc_id, COUNT(*) AS n FROM doc_terms GROUP BY doc_id
), totals AS (
 SELECT COUNT(*) AS n_docs, SUM(n)::BIGINT AS n_terms FROM sizes
), found AS (
 SELECT doc_id, term, COUNT(*) AS tf FROM doc_terms WHERE term IN (SELECT term FROM item_terms) GROUP BY doc_id, term
), weights AS (
 SELECT term, FLOOR(1000 * LN((2 * MAX(n_docs) + 2) / (2 * COUNT(*) + 1)))::BIGINT AS w FROM found, totals GROUP BY term
), scored AS (
 SELECT item_id, doc_id, SUM(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
 FROM found JOIN item_terms USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), totals GROUP BY item_id, doc_id
), ranked AS (
 SELECT item_id, ROW_NUMBER() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM scored WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 20
"""

HARD_NEGATIVES_SQL = r"""
WITH valid AS (
 SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  LIST_TRANSFORM(embedding, lambda x: FLOOR(256 * x::DOUBLE)) AS v
 FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
  AND LEN(LIST_FILTER(embedding, lambda x: x IS NULL OR NOT ISFINITE(x))) = 0
), scores AS (
 SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, LIST_DOT_PRODUCT(a.v, r.v)::BIGINT AS score
 FROM valid a JOIN valid r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
 SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
 QUALIFY ROW_NUMBER() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id,
 ROW_NUMBER() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
 vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scores s ON p.anchor_id = s.anchor_id AND NOT same
 AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
