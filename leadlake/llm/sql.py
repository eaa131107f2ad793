"""DuckDB SQL for the queries that SQL can express."""

LINE_FREQUENCY = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x : x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x : regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents
), wins AS (
  SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
  FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)
), rep AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM wins) WHERE n > 1
), covered AS (
  SELECT r, count(DISTINCT i + o) AS n FROM rep, (SELECT unnest([0, 1, 2]) AS o) GROUP BY r
), lines AS (
  SELECT r, doc_id, source, text,
         trim(regexp_replace(lower(l), '[\x20\x09-\x0D]+', ' ', 'g')) AS line
  FROM (SELECT r, doc_id, source, text, unnest(ls) AS l FROM d)
), host AS (
  SELECT source, count(DISTINCT text) AS docs FROM d GROUP BY source
), above AS (
  SELECT l.source, l.line, min(l.doc_id) AS first
  FROM lines l JOIN host h ON l.source IS NOT DISTINCT FROM h.source
  GROUP BY l.source, l.line, h.docs
  HAVING count(DISTINCT l.text) > greatest(20, 0.05 * h.docs)
), lost AS (
  SELECT l.r, sum(length(l.line)) AS line_chars,
         coalesce(sum(length(l.line)) FILTER (WHERE a.line IS NOT NULL AND l.doc_id <> a.first), 0) AS removed_chars
  FROM lines l LEFT JOIN above a ON l.source IS NOT DISTINCT FROM a.source AND l.line = a.line
  GROUP BY l.r
), m AS (
  SELECT d.doc_id, len(w) AS n_words, len(array_to_string(w, '')) AS word_chars,
         len(regexp_extract_all(d.text, '[#*$%&|<>]')) AS n_symbols,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines,
         coalesce(c.n, 0) AS n_repeat_words,
         coalesce(lost.line_chars, 0)::BIGINT AS line_chars,
         coalesce(lost.removed_chars, 0)::BIGINT AS removed_chars
  FROM d LEFT JOIN covered c USING (r) LEFT JOIN lost USING (r)
)
SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
       AND NOT (removed_chars > 0.7 * line_chars) AS kept
FROM m
"""

NEAR_DUPLICATES = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(
    string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda x : x <> '') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM d WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n, sum(hash(g)) AS content FROM s GROUP BY doc_id
), reps AS (
  SELECT content, n, min(doc_id) AS rep FROM n GROUP BY content, n
), t AS (
  SELECT s.doc_id, s.g, reps.n FROM s JOIN reps ON s.doc_id = reps.rep
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM t a JOIN t b ON a.g = b.g AND a.doc_id < b.doc_id
   AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(x, y) AS (
  SELECT rep, rep FROM reps
  UNION
  SELECT reach.x, both_ways.b FROM reach JOIN both_ways ON reach.y = both_ways.a
), component AS (
  SELECT x, min(y) AS component_id FROM reach GROUP BY x
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles,
       coalesce(c.component_id, d.doc_id) AS component_id,
       coalesce(c.component_id, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id)
LEFT JOIN reps r ON n.content = r.content AND n.n = r.n
LEFT JOIN component c ON r.rep = c.x
"""

SECRETS = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), pattern(k, kind, re) AS (VALUES
  (0, 'assign', '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+'),
  (1, 'access', 'AKIA[A-Z0-9]+'),
  (2, 'hex', '[0-9a-f]{24,}'),
  (3, 'run', '[A-Za-z0-9+/_=-]{20,}')
), found AS (
  SELECT r, k, i, m[i] AS t, len(gap[i]) AS g
  FROM (SELECT r, k, m, gap, unnest(generate_series(1, len(m))) AS i
        FROM (SELECT r, k, regexp_extract_all(text, re) AS m, string_split_regex(text, re) AS gap
              FROM d, pattern WHERE regexp_matches(text, re)))
), spans AS (
  SELECT r, k, t, sum(g + len(t)) OVER (PARTITION BY r, k ORDER BY i) - len(t) AS s,
         sum(g + len(t)) OVER (PARTITION BY r, k ORDER BY i) AS e
  FROM found
), base AS (
  SELECT r, k, s, e FROM spans
  WHERE (k = 0 AND len(regexp_extract(t, '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1)) >= 6)
     OR (k = 1 AND len(t) >= 20) OR k = 2
), candidate AS (
  SELECT row_number() OVER () AS c, r, s, t,
         CASE WHEN regexp_full_match(t, '[0-9a-fA-F]+') THEN 3.0 ELSE 3.7 END AS bits
  FROM spans
  WHERE k = 3 AND regexp_matches(t, '[0-9]') AND regexp_matches(t, '[A-Za-z]')
    AND NOT regexp_matches(t, '(?i)example|placeholder|changeme|dummy|redacted|lorem')
    AND NOT regexp_full_match(t, '(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}')
), windows AS (
  SELECT c, r, s, bits, i, substring(t, i + 1, 20) AS w
  FROM (SELECT *, unnest(range(0, len(t) - 19)) AS i FROM candidate)
), hot AS (
  SELECT c, r, s, i FROM (
    SELECT c, r, s, bits, i, ch, count(*) AS n
    FROM (SELECT c, r, s, bits, i, unnest(string_split(w, '')) AS ch FROM windows) GROUP BY ALL)
  GROUP BY c, r, s, bits, i HAVING -sum(n / 20.0 * log2(n / 20.0)) >= bits - 1e-9
), entropy AS (
  SELECT r, 3 AS k, s + min(i) AS s, s + max(i) + 20 AS e FROM hot GROUP BY c, r, s
), listed AS (
  SELECT r, k, s, e, CASE k WHEN 3 THEN 'entropy' ELSE kind END || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT) AS span
  FROM (SELECT * FROM base UNION ALL SELECT * FROM entropy) JOIN pattern USING (k)
), per_row AS (
  SELECT r, count(*) FILTER (WHERE k = 0) AS n_assign, count(*) FILTER (WHERE k = 1) AS n_access,
         count(*) FILTER (WHERE k = 2) AS n_hex, count(*) FILTER (WHERE k = 3) AS n_entropy,
         string_agg(span, ',' ORDER BY s, k) FILTER (WHERE k < 3) AS base,
         string_agg(span, ',' ORDER BY s, k) AS spans
  FROM listed GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       coalesce(n_entropy, 0) AS n_entropy, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN per_row USING (r)
"""

MIXING = r"""
WITH RECURSIVE counted AS (
  SELECT source, count(*) AS n, row_number() OVER (ORDER BY source NULLS LAST) AS i FROM documents GROUP BY source
), settings AS (
  SELECT count(*) AS s, greatest(1024, 16 * count(*)) AS q, sum(sqrt(n)) AS total FROM counted
), exact AS (
  SELECT source, i, sqrt(n) / total * (q - s) AS x, q, s FROM counted, settings
), ranked AS (
  SELECT *, floor(x)::BIGINT AS whole, row_number() OVER (ORDER BY floor(x) - x, i) AS place,
         (q - s) - sum(floor(x)::BIGINT) OVER () AS spare
  FROM exact
), share AS (
  SELECT source, i, q, whole + 1 + CASE WHEN place <= spare THEN 1 ELSE 0 END AS a FROM ranked
), lists AS (
  SELECT list(a ORDER BY i) AS a, any_value(q) AS q, list_transform(range(count(*)), lambda x : 0::BIGINT) AS none FROM share
), slots(t, given, pick) AS (
  SELECT -1::BIGINT, none, 0::BIGINT FROM lists
  UNION ALL
  SELECT t + 1, list_transform(given, lambda c, k : CASE WHEN k = chosen THEN c + 1 ELSE c END), chosen
  FROM (
    SELECT t, given, list_min(list_filter(list_transform(range(1, len(a) + 1), lambda k :
             CASE WHEN given[k] < a[k] AND (given[k] * q) // a[k] <= t + 1
                  THEN (((given[k] + 1) * q + a[k] - 1) // a[k]) * 1000000 + k END),
             lambda v : v IS NOT NULL)) % 1000000 AS chosen
    FROM slots, lists WHERE t + 1 < q)
), scheduled AS (
  SELECT pick AS i, given[pick] - 1 AS j, t AS slot FROM slots WHERE t >= 0
), placed AS (
  SELECT doc_id, d.source, sh.i, a, q, row_number() OVER (PARTITION BY d.source ORDER BY
           md5(concat('5|', coalesce(CAST(doc_id AS VARCHAR), ''), '|', coalesce(d.source, ''))), doc_id) - 1 AS k
  FROM documents d JOIN share sh ON d.source IS NOT DISTINCT FROM sh.source
), blocks AS (
  SELECT *, k // 16 AS block, ((k // 16) // a) * q AS round, (k // 16) % a AS j FROM placed
)
SELECT doc_id, source, block, (round + (b.j * q) // a)::BIGINT AS release,
       (round + ((b.j + 1) * q + a - 1) // a)::BIGINT AS deadline, (round + slot)::BIGINT AS slot,
       ((round + slot) * 16 + k % 16)::BIGINT AS position
FROM blocks b JOIN scheduled s ON b.i = s.i AND b.j = s.j
"""

ARCHIVES = r"""
WITH d AS (
  SELECT page_id, strlen(coalesce(html, '')) AS b, sha1(coalesce(html, '')) AS g FROM pages
), f AS (
  SELECT g, b, max(page_id) AS m FROM d WHERE b >= 1000 GROUP BY g, b
)
SELECT page_id, b::BIGINT AS payload_bytes, d.g AS payload_digest,
       CASE WHEN f.g IS NOT NULL AND page_id IS DISTINCT FROM m THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM m THEN m END AS refers_to
FROM d LEFT JOIN f USING (g, b)
"""

COLLOCATIONS = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x : x <> '') AS w FROM p
), f AS (
  SELECT lang, k, w[i:i + k - 1] AS words, count(*) AS a
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3]) AS k))
  GROUP BY ALL
), n AS (
  SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang
), c AS (
  SELECT * FROM f WHERE k > 1 AND a >= 10
), cut AS (
  SELECT c.lang, c.words, c.a, c.j, l.a AS l, r.a AS r,
         (1000000::HUGEINT * c.a * c.a) // (l.a::HUGEINT * r.a) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c
  JOIN f l ON l.lang = c.lang AND l.words = c.words[:c.j]
  JOIN f r ON r.lang = c.lang AND r.words = c.words[c.j + 1:]
), least AS (
  SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, j) = 1
), inside AS (
  SELECT lang, words, max(a) AS longer
  FROM (SELECT lang, words[s:s + 1] AS words, a FROM c, (SELECT unnest([1, 2]) AS s) WHERE k = 3)
  GROUP BY lang, words
), kept AS (
  SELECT lang, array_to_string(words, ' ') AS phrase, least.a, l, r, score
  FROM least LEFT JOIN inside USING (lang, words)
  WHERE longer IS NULL OR 100 * longer < 50 * least.a
)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
JOIN n USING (lang) WHERE rank <= 2000
"""

PREFIXES = r"""
WITH t AS (
  SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
), o AS (
  SELECT c, list(sha256(length(role) || ':' || role || text) ORDER BY turn NULLS FIRST, role, text) AS ids,
         list(strlen(text) ORDER BY turn NULLS FIRST, role, text) AS sizes,
         -- CRC-32 bit by bit: a byte comes in at every eighth step
         xor(4294967295, list_reduce(range(-1, 8 * length(c::VARCHAR)), lambda acc, k :
           CASE WHEN xor(CASE WHEN acc = -1 THEN 4294967295 ELSE acc END, CASE WHEN k % 8 = 0 THEN ascii(substr(c::VARCHAR, (k // 8 + 1)::INT, 1)) ELSE 0 END) & 1 = 1
                THEN xor(xor(CASE WHEN acc = -1 THEN 4294967295 ELSE acc END, CASE WHEN k % 8 = 0 THEN ascii(substr(c::VARCHAR, (k // 8 + 1)::INT, 1)) ELSE 0 END) >> 1, 3988292384)
                ELSE xor(CASE WHEN acc = -1 THEN 4294967295 ELSE acc END, CASE WHEN k % 8 = 0 THEN ascii(substr(c::VARCHAR, (k // 8 + 1)::INT, 1)) ELSE 0 END) >> 1 END)) % 9 AS h
  FROM t GROUP BY c
), full_ AS (
  SELECT o.c, list_concat(coalesce(b.ids, [])[:o.h], o.ids[o.h + 1:]) AS ids,
         list_concat(coalesce(b.sizes, [])[:o.h], o.sizes[o.h + 1:]) AS sizes
  FROM o LEFT JOIN o b ON b.c = o.c - o.c % 5
), member AS (
  SELECT c, ids, len(ids) AS size, d, array_to_string(ids[:d], ',') AS node,
         CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS bytes
  FROM (SELECT *, unnest(range(0, len(ids) + 1)) AS d FROM full_)
), node AS (
  SELECT node, d, min(c) AS c, count(*) AS n, any_value(ids[:d]) AS ids, (count(*) - 1) * any_value(bytes) AS saved,
         CASE WHEN d > 0 THEN array_to_string(any_value(ids[:d - 1]), ',') END AS parent,
         coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE size = d), '') AS ends
  FROM member GROUP BY node, d
), children AS (
  SELECT parent AS node, count(*) AS k FROM node WHERE d > 0 GROUP BY parent
), share AS (
  SELECT ids, d, saved, CASE WHEN k IS NULL THEN 1 ELSE 0 END AS leaf FROM node LEFT JOIN children USING (node)
), total AS (
  SELECT array_to_string(ids[:e], ',') AS node, sum(leaf) AS leaves, sum(saved) AS saved
  FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM share) GROUP BY array_to_string(ids[:e], ',')
)
SELECT n.c AS conv_id, n.d AS depth, p.c AS parent_conv_id, n.n AS n_convs, coalesce(k, 0) AS n_children,
       leaves::BIGINT AS n_leaves, total.saved::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM node n LEFT JOIN node p ON n.parent = p.node LEFT JOIN children ch ON ch.node = n.node JOIN total ON total.node = n.node
"""

ORACLE = {
    "op4_pfair": MIXING,
    "op6_entropy_secrets": SECRETS,
    "op7_setsketch": NEAR_DUPLICATES,
    "op5_line_frequency": LINE_FREQUENCY,
    "op11_warc": ARCHIVES,
    "op12_hat_trie": COLLOCATIONS,
    "op13_prefix_trie": PREFIXES,
}
