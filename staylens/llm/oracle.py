"""The same results as SQL for DuckDB, where SQL can express them."""

from staylens.llm.oracle_simhash import simhash_sql

QUALITY_RULES = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
),
grams AS (
  SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 1, 1))) AS i FROM texts)
),
repeats AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM grams) WHERE n > 1
),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM repeats, (SELECT unnest(range(0, 3)) AS k) GROUP BY doc_id
),
counts AS (
  SELECT texts.doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
         length(t) - length(replace(t, '!', '')) AS n_exclamations,
         len(list_filter(words, lambda w: list_contains(string_split(
           'the of and to in is that for was with on as by this from or an be at it are not '
           || 'der die das und den von zu mit auf für im des ein eine ist nicht sich dem '
           || 'le la les des et en que une un pour dans qui sur par est du au '
           || 'el los las del y con por para se una como lo es su', ' '), lower(w)))) AS n_stop_words,
         len(lines) AS n_lines,
         len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) AS n_bullet_lines,
         len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_ellipsis_lines
  FROM texts LEFT JOIN covered USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
         AND word_chars >= 2 * n_words AND word_chars <= 12 * n_words
         AND 10 * n_symbols <= n_words AND 5 * n_exclamations <= n_words
         AND 100 * n_stop_words >= 3 * n_words
         AND 2 * n_dup_lines <= n_lines AND 10 * n_bullet_lines <= 9 * n_lines AND 10 * n_ellipsis_lines <= 3 * n_lines AS kept
FROM counts
"""

POISSON_MIX = """
WITH sizes AS (
  SELECT source, sum(octet_length(encode(coalesce(text, ''))) + 1) AS size FROM documents GROUP BY source
),
weighted AS (SELECT source, size, sqrt(CAST(size AS DOUBLE)) AS weight FROM sizes),
rates AS (
  SELECT source, weight / (SELECT sum(weight) FROM weighted) * (SELECT sum(size) FROM weighted) / size AS rate FROM weighted
),
chances AS (
  SELECT source, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1)))
    OVER (PARTITION BY source ORDER BY k ROWS UNBOUNDED PRECEDING) AS below
  FROM rates, (SELECT unnest(range(0, 200)) AS k)
),
drawn AS (
  SELECT *, md5(coalesce(text, '')) AS digest,
    (CAST('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || md5(coalesce(text, ''))), 1, 13) AS BIGINT) + 0.5)
      / 4503599627370496.0 AS u
  FROM documents
),
counted AS (
  SELECT drawn.*, (SELECT count(*) FROM chances WHERE chances.source IS NOT DISTINCT FROM drawn.source AND below <= u) AS copies FROM drawn
),
copied AS (SELECT *, unnest(range(1, copies + 1)) AS copy FROM counted)
SELECT doc_id, text, lang, source, n_chars, copy, copies,
  CAST('0x' || substr(md5('18:' || coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || digest || ':' || copy), 1, 13) AS BIGINT) AS shuffle_key
FROM copied
"""

VECTOR_APPROXIMATION = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

LINE_DEDUP = r"""
WITH lines AS (
  SELECT doc_id, line, place, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS place
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))
),
owners AS (
  SELECT key, min(doc_id) AS owner FROM lines WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1
),
judged AS (SELECT lines.*, owner IS NOT NULL AND owner <> doc_id AS gone FROM lines LEFT JOIN owners USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

BAG_SEARCH = r"""
WITH terms AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents
),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
),
lengths AS (SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id),
totals AS (SELECT count(*) AS all_docs, CAST(sum(n) AS BIGINT) AS all_terms FROM lengths),
counts AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY doc_id, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(all_docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM counts, totals GROUP BY term
),
measures AS (SELECT doc_id, 100 - 90 + (90 * n * all_docs) // all_terms AS m FROM lengths, totals),
scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN counts USING (term) JOIN weights USING (term) JOIN measures USING (doc_id) GROUP BY item_id, doc_id
),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

TURN_REPAIR = r"""
WITH RECURSIVE source AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: CAST(ascii(c) AS BIGINT)) AS bytes
  FROM conversations
),
ruled AS (
  SELECT conv_id, turn, role, text,
    xor(list_reduce(bytes, lambda crc, b: list_reduce([0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(crc, b)), 4294967295), 4294967295) % 20 AS rule
  FROM source
),
damaged AS (
  SELECT conv_id, turn, CASE WHEN rule = 4 THEN 'user' ELSE role END AS role,
    CASE rule WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN rule = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM ruled WHERE rule <> 0
),
placed AS (
  SELECT *, substr(role, 1, 1) AS initial, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM damaged
),
judged AS (
  SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS cut,
    coalesce(lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial, 'su') AS pair
  FROM placed
),
faults AS (
  SELECT conv_id, i, role, text, initial, pair, turn, blank, again AND NOT blank AS duplicate, cut AND NOT again AND NOT blank AS truncated FROM judged
),
figures AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM faults GROUP BY conv_id
),
inserts(p, r, made) AS (
  VALUES (0, 0, []), (0, 2, ['user:']), (0, 3, ['user:', 'assistant:']), (1, 1, []), (1, 2, ['user:']), (1, 3, ['user:', 'assistant:']),
    (2, 2, []), (2, 3, ['assistant:']), (3, 3, []), (3, 2, ['user:'])
),
kept(initial, r, q) AS (VALUES ('s', 0, 1), ('u', 0, 2), ('u', 1, 2), ('u', 3, 2), ('a', 2, 3)),
edits AS (
  SELECT conv_id, i, r, r AS q, 3 AS price, 'D' AS letter, CAST([] AS VARCHAR[]) AS line FROM faults, (VALUES (0), (1), (2), (3)) AS states(r)
  UNION ALL
  SELECT conv_id, i, r, q, CAST(truncated AS INTEGER), 'K', [role || ':' || text] FROM faults JOIN kept USING (initial) WHERE NOT blank AND NOT duplicate
  UNION ALL
  SELECT conv_id, i, r, q, 2 + CAST(truncated AS INTEGER), 'R', [name || ':' || text]
  FROM faults, (VALUES (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')) AS given(r, q, name) WHERE NOT blank AND NOT duplicate
),
walked AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, 0 AS state, {'cost': CAST(0 AS BIGINT), 'audit': '', 'made': CAST([] AS VARCHAR[])} AS best FROM figures
  UNION ALL
  SELECT w.conv_id, e.i, e.q AS state,
    min({'cost': CAST(w.best.cost + 2 * len(inserts.made) + e.price AS BIGINT), 'audit': w.best.audit || repeat('I', len(inserts.made)) || e.letter,
         'made': list_concat(list_concat(w.best.made, inserts.made), e.line)}) AS best
  FROM walked w JOIN inserts ON inserts.p = w.state JOIN edits e ON e.conv_id IS NOT DISTINCT FROM w.conv_id AND e.i = w.i + 1 AND e.r = inserts.r
  GROUP BY w.conv_id, e.i, e.q
),
ended AS (
  SELECT w.conv_id, min({'cost': CAST(best.cost + 2 * len(tail) AS BIGINT), 'audit': best.audit || repeat('I', len(tail)), 'made': list_concat(best.made, tail)}) AS best
  FROM walked w JOIN figures f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.n = w.i
    JOIN (VALUES (0, CAST([] AS VARCHAR[])), (1, ['user:', 'assistant:']), (2, ['assistant:']), (3, CAST([] AS VARCHAR[]))) AS tails(state, tail) USING (state)
  GROUP BY w.conv_id
)
SELECT ids.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0) AS cost, coalesce(best.audit, '') AS audit,
  sha256(coalesce(array_to_string(best.made, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) ids
  LEFT JOIN figures f ON f.conv_id IS NOT DISTINCT FROM ids.conv_id
  LEFT JOIN ended ON ended.conv_id IS NOT DISTINCT FROM ids.conv_id
"""

SUFFIX_DEDUP = """
WITH whole AS (SELECT doc_id, encode(coalesce(text, '')) AS data FROM documents),
starts AS (
  SELECT doc_id, i, data[i + 1:i + 200] AS piece
  FROM (SELECT doc_id, data, unnest(range(CAST(octet_length(data) AS BIGINT) - 199)) AS i FROM whole)
),
again AS (SELECT piece FROM starts GROUP BY piece HAVING count(*) > 1),
covering AS (
  SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 200 AS goes_on FROM starts SEMI JOIN again USING (piece)
),
numbered AS (SELECT doc_id, i, count(*) FILTER (goes_on IS NOT TRUE) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM covering),
spans AS (SELECT doc_id, min(i) AS start, max(i) + 200 AS stop FROM numbered GROUP BY doc_id, span),
cuts AS (
  SELECT doc_id, start, stop, lag(stop, 1, 0) OVER (PARTITION BY doc_id ORDER BY start) AS since FROM spans
  UNION ALL
  SELECT doc_id, octet_length(data), NULL, coalesce((SELECT max(stop) FROM spans WHERE spans.doc_id = whole.doc_id), 0) FROM whole
),
kept AS (
  SELECT doc_id, sum(stop - start) AS n_removed, count(stop) AS n_spans,
    string_agg(CASE WHEN since < start THEN hex(data[since + 1:start]) ELSE '' END, '' ORDER BY start, stop NULLS LAST) AS digits
  FROM cuts JOIN whole USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, CAST(octet_length(data) AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, n_spans,
  sha256(unhex(digits)) AS kept_sha256
FROM whole JOIN kept USING (doc_id)
"""

WARC = """
WITH payloads AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
judged AS (SELECT page_id, payload, sha1(payload) AS digits, min(page_id) OVER (PARTITION BY payload) AS first_id FROM payloads)
SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((CAST('0x' || substr(digits, i // 4 * 5 + 1, 5) AS INTEGER) >> CAST(15 - i % 4 * 5 AS INTEGER)) & 31), 1)), '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM judged
"""

ORACLE_SQL = {
    "op1_vector_approximation": VECTOR_APPROXIMATION,
    "op5_poisson_mix": POISSON_MIX,
    "op6_suffix_dedup": SUFFIX_DEDUP,
    "op7_warc": WARC,
    "op9_quality_rules": QUALITY_RULES,
    "op10_simhash": simhash_sql(seed=42, shingle=3, max_bits=2),
    "op11_line_dedup": LINE_DEDUP,
    "op12_bag_search": BAG_SEARCH,
    "op13_turn_repair": TURN_REPAIR,
}
