"""SQL that states the results of those queries that SQL can express."""

RULES = r"""
WITH texts AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
parts AS (
  SELECT doc_id, source, t,
         list_filter(string_split_regex(t, '[ \t-\r]+'), lambda w: w <> '') AS words,
         list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^ \t-\r]')) AS lines
  FROM texts),
windows AS (
  SELECT doc_id, unnest(range(1, len(words) - 3)) AS place,
         unnest(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) AS w
  FROM parts WHERE len(words) >= 5),
twice AS (
  SELECT doc_id, place FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows) WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT place + k) AS n FROM twice, (SELECT unnest(range(5)) AS k) GROUP BY doc_id),
counts AS (
  SELECT doc_id, source, len(words)::BIGINT AS n_words,
         length(array_to_string(words, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines
  FROM parts LEFT JOIN covered USING (doc_id)),
failed AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         100 * n_symbols > 10 * word_chars AS symbols_failed,
         100 * n_dup_lines > 30 * n_lines AS lines_failed
  FROM counts),
hosts AS (
  SELECT source, count(*) AS n, count(*) FILTER (base_failed) AS b,
         count(*) FILTER (symbols_failed) AS s, count(*) FILTER (lines_failed) AS l
  FROM failed WHERE source IS NOT NULL GROUP BY source),
prior AS (
  SELECT avg(b / n) AS mb, coalesce(var_samp(b / n), 0) AS vb,
         avg(s / n) AS ms, coalesce(var_samp(s / n), 0) AS vs,
         avg(l / n) AS ml, coalesce(var_samp(l / n), 0) AS vl FROM hosts),
strengths AS (
  SELECT *, CASE WHEN vb > 0 THEN greatest(1, mb * (1 - mb) / vb - 1) ELSE 100 END AS kb,
         CASE WHEN vs > 0 THEN greatest(1, ms * (1 - ms) / vs - 1) ELSE 100 END AS ks,
         CASE WHEN vl > 0 THEN greatest(1, ml * (1 - ml) / vl - 1) ELSE 100 END AS kl FROM prior),
shrunk AS (
  SELECT source, (b + kb * mb) / (n + kb) AS rb, n + kb + 1 AS wb, (s + ks * ms) / (n + ks) AS rs, n + ks + 1 AS ws,
         (l + kl * ml) / (n + kl) AS rl, n + kl + 1 AS wl
  FROM hosts, strengths),
rates AS (
  SELECT source, greatest(rb - 1.96 * sqrt(rb * (1 - rb) / wb), rs - 1.96 * sqrt(rs * (1 - rs) / ws),
                          rl - 1.96 * sqrt(rl * (1 - rl) / wl)) AS worst
  FROM shrunk)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(worst, 0) <= 0.25 AS kept
FROM failed LEFT JOIN rates USING (source)
"""

NEAR = r"""
WITH RECURSIVE parts AS (
  SELECT doc_id, list_filter(
    string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t-\r]+'),
    lambda w: w <> '') AS words
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE
    WHEN len(words) >= 5 THEN list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))
    WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS shingles
  FROM parts),
sizes AS (SELECT doc_id, len(shingles)::BIGINT AS n_shingles FROM sets),
members AS (SELECT doc_id, unnest(shingles) AS shingle FROM sets),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM members a JOIN members b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * n >= 75 * (x.n_shingles + y.n_shingles - n)),
reached AS (
  SELECT doc_id AS a, doc_id AS b FROM sizes
  UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
classes AS (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a)
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept
FROM sizes JOIN classes USING (doc_id)
"""

LINES = r"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
lines AS (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS place FROM split),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
common AS (
  SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT doc_id, line, place, last IS NOT NULL AND doc_id <> last AS gone
  FROM keyed LEFT JOIN common USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

TRIE = r"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS place,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, max(place) AS n, conv_id - conv_id % 20 AS lender,
         xor(list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
                         lambda c, x: list_reduce(
                           [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0],
                           lambda v, i: xor(v >> 1, CASE WHEN v % 2 = 1 THEN 3988292384 ELSE 0 END),
                           xor(c, x)),
                         CAST(4294967295 AS BIGINT)),
             CAST(4294967295 AS BIGINT)) % 4 AS heads
  FROM turns GROUP BY conv_id),
rules AS (
  SELECT c.*, least(c.heads, coalesce(l.n, 0)) AS borrowed
  FROM convs c LEFT JOIN convs l ON l.conv_id = c.lender),
rebuilt AS (
  SELECT r.conv_id, t.place AS depth, role, text
  FROM rules r JOIN turns t ON t.conv_id = r.lender AND t.place <= r.borrowed
  UNION ALL
  SELECT r.conv_id, t.place - r.heads + r.borrowed, role, text
  FROM rules r JOIN turns t ON t.conv_id = r.conv_id AND t.place > r.heads),
steps AS (
  SELECT conv_id, depth, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
         string_agg(md5(md5(role) || md5(text)), '') OVER (PARTITION BY conv_id ORDER BY depth) AS path
  FROM rebuilt),
members AS (
  SELECT conv_id, 0 AS depth, 0 AS words, '' AS path FROM rules
  UNION ALL SELECT conv_id, depth, words, path FROM steps),
nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words
  FROM members GROUP BY path, depth),
finished AS (SELECT conv_id, max_by(path, depth) AS path FROM members GROUP BY conv_id),
ends AS (SELECT path, string_agg(conv_id, ',' ORDER BY conv_id) AS ids FROM finished GROUP BY path),
children AS (
  SELECT substr(path, 1, length(path) - 32) AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
valued AS (
  SELECT path, depth, CASE WHEN c.n IS NULL THEN 1 ELSE 0 END AS leaf, (n_convs - 1) * words AS saved
  FROM nodes LEFT JOIN children c USING (path)),
above AS (SELECT leaf, saved, substr(path, 1, 32 * unnest(range(0, depth + 1))) AS path FROM valued),
sums AS (SELECT path, sum(leaf) AS leaves, sum(saved) AS saved FROM above GROUP BY path)
SELECT CAST(n.conv_id AS BIGINT) AS conv_id, CAST(n.depth AS BIGINT) AS depth,
       CAST(p.conv_id AS BIGINT) AS parent_conv_id, CAST(n.n_convs AS BIGINT) AS n_convs,
       CAST(coalesce(c.n, 0) AS BIGINT) AS n_children, CAST(leaves AS BIGINT) AS n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes n JOIN sums USING (path) LEFT JOIN children c USING (path) LEFT JOIN ends USING (path)
LEFT JOIN nodes p ON n.depth > 0 AND p.path = substr(n.path, 1, length(n.path) - 32)
"""

SEARCH = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
asked AS (
  SELECT item_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
wanted AS (SELECT item_id, term, count(*) AS times FROM asked GROUP BY ALL),
lengths AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths),
counts AS (
  SELECT doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
held AS (SELECT term, count(*) AS df FROM counts GROUP BY term),
valued AS (
  SELECT doc_id, term,
         CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT)
           * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms))) AS value
  FROM counts JOIN held USING (term) JOIN lengths USING (doc_id), total),
scores AS (
  SELECT item_id, doc_id, CAST(sum(times * value) AS BIGINT) AS score
  FROM wanted JOIN valued USING (term) GROUP BY ALL HAVING sum(times * value) > 0),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
         doc_id, score
  FROM scores)
SELECT * FROM ranked WHERE rank <= 10
"""

ORACLES = {
    "op8_min_max": NEAR,
    "op9_host_rules": RULES,
    "op11_line_bitmaps": LINES,
    "op12_prefix_trie": TRIE,
    "op13_shared_search": SEARCH,
}
