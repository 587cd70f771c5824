"""DuckDB SQL of the text queries that SQL can express, written apart from the Spark code."""

QUALITY = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS body,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
lines AS (
  SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT rid, unnest(string_split(body, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
places AS (SELECT rid, words, unnest(range(1, len(words) - 3)) AS i FROM d WHERE len(words) >= 5),
windows AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, words[i], words[i + 1], words[i + 2], words[i + 3], words[i + 4]) AS n FROM places),
again AS (
  SELECT rid, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT rid, unnest(range(i, i + 5)) AS p FROM windows WHERE n > 1) GROUP BY rid),
counts AS MATERIALIZED (
  SELECT d.rid, doc_id, source, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(body, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(body, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN lines USING (rid) LEFT JOIN again USING (rid)),
failures AS (
  SELECT *, n_words < 10 AS few, 100 * n_repeat_words > 20 * n_words AS repeated, 100 * n_symbols > 30 * word_chars AS symbols FROM counts),
long AS (
  SELECT source, unnest(['few', 'repeated', 'symbols']) AS rule, unnest([few, repeated, symbols]) AS failed
  FROM failures WHERE source IS NOT NULL),
hosts AS (SELECT source, rule, count(*)::DOUBLE AS n, sum(failed::INT)::DOUBLE AS f FROM long GROUP BY ALL),
moments AS (SELECT rule, sum(f) / sum(n) AS m, sum(f * f / n) / sum(n) - (sum(f) / sum(n)) * (sum(f) / sum(n)) AS v FROM hosts GROUP BY rule),
prior AS (
  SELECT rule, m, CASE WHEN v > 1e-12 THEN least(greatest(m * (1 - m) / v - 1, 10.0), 10000.0) ELSE 10000.0 END AS w FROM moments),
bad AS (SELECT DISTINCT source FROM hosts JOIN prior USING (rule) WHERE (f + m * w) / (n + w) > 0.5)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, few OR repeated AS base_failed,
  NOT (few OR repeated OR coalesce(source IN (SELECT source FROM bad), false)) AS kept
FROM failures
"""

REPEATS = r"""
WITH d AS MATERIALIZED (SELECT doc_id, encode(coalesce(text, '')) AS body FROM documents),
places AS (SELECT doc_id, body, unnest(range(0, octet_length(body) - 49)) AS i FROM d WHERE octet_length(body) >= 50),
windows AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY body[i + 1 : i + 50]) AS first_doc FROM places),
starts AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM windows WHERE first_doc < doc_id),
runs AS (SELECT doc_id, i, sum((before IS NULL OR i > before + 50)::INT) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM starts),
gone AS (SELECT doc_id, run, min(i) AS low, max(i) + 50 AS high FROM runs GROUP BY doc_id, run),
ends AS (
  SELECT doc_id, high AS low, coalesce(lead(low) OVER (PARTITION BY doc_id ORDER BY low), 2147483647) AS high FROM gone
  UNION ALL SELECT doc_id, 0, min(low) FROM gone GROUP BY doc_id),
left_over AS (
  SELECT doc_id, unhex(string_agg(hex(body[e.low + 1 : e.high]), '' ORDER BY e.low)) AS kept FROM d JOIN ends e USING (doc_id) GROUP BY doc_id),
sums AS (SELECT doc_id, sum(high - low) AS n_removed, count(*) AS n_spans FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(octet_length(body) AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(coalesce(kept, body)) AS kept_sha256
FROM d LEFT JOIN sums USING (doc_id) LEFT JOIN left_over USING (doc_id)
"""

NEAR = r"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents WHERE regexp_matches(text, '[^\x20\x09-\x0D]')),
places AS (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM d),
shingles AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(words[i : i + 4], ' ') AS s FROM places),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM shingles x JOIN shingles y USING (s) WHERE x.doc_id < y.doc_id GROUP BY ALL),
links AS MATERIALIZED (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * shared.n >= 75 * (p.n + q.n - shared.n)),
edges AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT DISTINCT a AS node, a AS found FROM edges
  UNION
  SELECT reach.node, edges.b FROM reach JOIN edges ON reach.found = edges.a),
least_found AS (SELECT node, min(found) AS component FROM reach GROUP BY node)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(component, doc_id) AS component_id,
  coalesce(component, doc_id) = doc_id AS kept
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN least_found ON node = doc_id
"""

LINES = r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
places AS (SELECT rid, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM d),
keyed AS MATERIALIZED (
  SELECT rid, place, line,
    translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM places),
common AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT rid) >= 10),
kept AS (
  SELECT rid, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '') AS kept
  FROM (SELECT *, key IN (SELECT key FROM common) AS gone FROM keyed) GROUP BY rid)
SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM d JOIN kept USING (rid)
"""

IMPORTANCE = r"""
WITH RECURSIVE rounds AS (
  SELECT CAST(range AS BIGINT) AS i, 0 AS k, CAST(range AS BIGINT) AS v FROM range(256)
  UNION ALL
  SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM rounds WHERE k < 8),
crc_table AS MATERIALIZED (SELECT list(v ORDER BY i) AS steps FROM rounds WHERE k = 8),
texts AS (
  SELECT 's' AS side, row_number() OVER () AS rid, doc_id, text FROM documents
  UNION ALL SELECT 't', row_number() OVER (), NULL, text FROM benchmark),
d AS MATERIALIZED (
  SELECT side, rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM texts),
places AS MATERIALIZED (SELECT side, rid, unnest(words) AS word FROM d),
vocabulary AS (
  SELECT word, list_transform(range(1, length(hex(word)) + 1, 2), lambda i: CAST('0x' || substr(hex(word), i, 2) AS BIGINT)) AS bytes
  FROM (SELECT DISTINCT word FROM places)),
hashed AS MATERIALIZED (
  SELECT word, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bytes),
    lambda c, b: xor(c >> 8, steps[CAST((xor(c, b) & 255) + 1 AS INTEGER)])), 4294967295) % 10000 AS bucket
  FROM vocabulary, crc_table),
features AS MATERIALIZED (SELECT side, rid, bucket FROM places JOIN hashed USING (word)),
counts AS (SELECT bucket, count(*) FILTER (side = 's') AS s, count(*) FILTER (side = 't') AS t FROM features GROUP BY bucket),
sums AS (SELECT coalesce(sum(s), 0)::DOUBLE AS all_s, coalesce(sum(t), 0)::DOUBLE AS all_t FROM counts),
gains AS (
  SELECT bucket, floor(1000::DOUBLE * ln(((t + 1)::DOUBLE * (all_s + 10000)) / ((s + 1)::DOUBLE * (all_t + 10000)))) AS gain FROM counts, sums),
weights AS (SELECT rid, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight FROM features JOIN gains USING (bucket) WHERE side = 's' GROUP BY rid),
scores AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000::DOUBLE * ln(-ln(
    (CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT)::DOUBLE + 0.5) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM d LEFT JOIN weights USING (rid) WHERE side = 's'),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY n_features >= 20) AS n FROM scores)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= n * 10 // 100 THEN place END AS rank FROM ranked
"""
