"""DuckDB SQL for the queries that SQL can express on whole tables."""

URL_FILTERS = r"""
WITH parts AS (
  SELECT page_id, url,
         regexp_replace(lower(regexp_extract(url, '^\s*[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:\s]*)', 1)), '\.+$', '') AS host,
         regexp_replace(regexp_extract(url, '^\s*[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '^/+|/+$', '', 'g') AS path,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(page_id % 43200) AS fetched_at
  FROM pages),
moments AS (
  SELECT event_type AS list,
         CASE WHEN event_id % 3 = 0 THEN CASE WHEN path <> '' THEN host || '/' || path ELSE host END
              WHEN event_id % 3 = 1 THEN host
              ELSE regexp_extract(host, '([^.]+\.[^.]+)$', 1) END AS rule,
         ts AS dated,
         max(CASE WHEN event_id % 4 = 0 THEN 'remove' ELSE 'add' END) AS action
  FROM events JOIN parts ON user_id = page_id GROUP BY ALL),
labels_of AS (SELECT *, string_split(host, '.') AS labels, regexp_split_to_array(path, '/+') AS steps FROM parts),
candidates AS (
  SELECT DISTINCT page_id, url, fetched_at, unnest(
    CASE WHEN host = '' THEN CAST([] AS VARCHAR[]) ELSE
      list_transform(range(1, len(labels) + 1), lambda i: array_to_string(labels[i:], '.')) ||
      CASE WHEN path = '' THEN CAST([] AS VARCHAR[]) ELSE
        list_transform(range(1, len(steps) + 1), lambda i: host || '/' || array_to_string(steps[1:i], '/')) END END) AS rule
  FROM labels_of),
states AS (
  SELECT page_id, url, fetched_at, c.rule, list, arg_max(action, dated) AS action
  FROM candidates c JOIN moments m ON c.rule = m.rule AND m.dated <= c.fetched_at GROUP BY ALL),
decided AS (
  SELECT page_id, url, count(*) AS n_active, string_agg(DISTINCT list, ',' ORDER BY list) AS lists,
         arg_max(rule, (length(rule), rule)) AS rule,
         coalesce(max(length(rule)) FILTER (list <> 'signup'), 0) > coalesce(max(length(rule)) FILTER (list = 'signup'), 0) AS blocked
  FROM states WHERE action = 'add' GROUP BY page_id, url)
SELECT DISTINCT p.page_id, p.url, coalesce(n_active, 0) AS n_active, coalesce(lists, '') AS lists, coalesce(rule, '') AS rule,
       coalesce(blocked, false) AS blocked
FROM parts p LEFT JOIN decided d ON p.page_id = d.page_id AND p.url IS NOT DISTINCT FROM d.url
"""

NEAR_DUPLICATES = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(
    CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
  FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT u, v FROM shared s JOIN sizes a ON a.doc_id = u JOIN sizes b ON b.doc_id = v
  WHERE 100 * s.n >= 85 * (a.n + b.n - s.n)),
both_ways AS (SELECT u, v FROM links UNION SELECT v, u FROM links),
reach(node, seen) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.node, l.v FROM reach r JOIN both_ways l ON r.seen = l.u)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN sizes s ON d.doc_id = s.doc_id
JOIN (SELECT node, min(seen) AS component_id FROM reach GROUP BY node) c ON d.doc_id = c.node
"""

QUOTATION_LINKING = r"""
WITH RECURSIVE turns AS (SELECT conv_id, turn, min(text) AS text FROM conversations GROUP BY conv_id, turn),
messages AS (
  SELECT conv_id * 1000 + turn AS message_id, role, coalesce(text, '') AS text, conv_id, turn FROM conversations),
parts AS (
  SELECT DISTINCT text, trim(regexp_replace(lower(unnest(regexp_split_to_array(text, '\n([\s\v]*\n)+'))), '[\s\v]+', ' ', 'g')) AS k
  FROM (SELECT text FROM messages UNION SELECT text FROM turns)),
sizes AS (SELECT DISTINCT k, len(string_split(k, ' ')) < 5 AS short FROM parts),
own AS (SELECT DISTINCT message_id, k FROM messages JOIN parts USING (text) WHERE k <> ''),
quoted AS (
  SELECT m.message_id, 1 AS level, trim(regexp_replace(lower(unnest(regexp_split_to_array(t.text, '\n([\s\v]*\n)+'))), '[\s\v]+', ' ', 'g')) AS k
  FROM messages m JOIN turns t ON m.conv_id = t.conv_id AND m.turn = t.turn + 1
  UNION ALL
  SELECT m.message_id, 2, trim(regexp_replace(lower(unnest(regexp_split_to_array(t.text, '\n([\s\v]*\n)+'))), '[\s\v]+', ' ', 'g'))
  FROM messages m JOIN turns t ON m.conv_id = t.conv_id AND m.turn = t.turn + 2),
lines AS (SELECT row_number() OVER () AS line, message_id, level, k, short FROM quoted JOIN sizes USING (k) WHERE k <> ''),
linked AS (
  SELECT line, l.message_id, level, l.k, max(o.message_id) AS original
  FROM lines l JOIN own o ON l.k = o.k AND o.message_id < l.message_id
  GROUP BY line, l.message_id, level, l.k, short HAVING NOT short OR count(*) = 1),
per_original AS (
  SELECT message_id, level, original, sum(length(k)) AS chars, count(*) AS n FROM linked GROUP BY ALL),
parents AS (
  SELECT message_id, arg_max(original, (-level, chars, original)) AS parent_id, sum(n) AS n_linked FROM per_original GROUP BY 1),
roots AS (SELECT message_id FROM messages EXCEPT SELECT message_id FROM parents),
tree(message_id, conversation_id, depth) AS (
  SELECT message_id, message_id, 0::BIGINT FROM roots
  UNION ALL
  SELECT p.message_id, t.conversation_id, t.depth + 1 FROM tree t JOIN parents p ON p.parent_id = t.message_id),
totals AS (SELECT message_id, count(*) AS n FROM lines GROUP BY 1),
threads AS (SELECT DISTINCT message_id, conversation_id FROM tree),
single AS (
  SELECT k, message_id FROM own UNION
  SELECT trim(regexp_replace(lower(unnest(string_split(text, chr(10)))), '[\s\v]+', ' ', 'g')), message_id FROM messages),
near AS (
  SELECT l.message_id, count(DISTINCT line) AS n FROM lines l ANTI JOIN linked USING (line)
  JOIN threads t ON t.message_id = l.message_id JOIN single o ON o.k = l.k AND o.message_id < l.message_id
  JOIN threads u ON u.message_id = o.message_id AND u.conversation_id = t.conversation_id WHERE short GROUP BY 1)
SELECT m.message_id, t.conversation_id, p.parent_id,
       row_number() OVER (PARTITION BY t.conversation_id ORDER BY m.message_id) AS position, t.depth, m.role,
       trim(m.text, chr(32) || chr(9) || chr(13) || chr(10)) AS text,
       coalesce(q.n, 0) AS n_quoted, CAST(coalesce(p.n_linked, 0) + coalesce(w.n, 0) AS BIGINT) AS n_linked
FROM messages m JOIN tree t ON m.message_id = t.message_id LEFT JOIN near w ON m.message_id = w.message_id
LEFT JOIN parents p ON m.message_id = p.message_id LEFT JOIN totals q ON m.message_id = q.message_id
"""

SOURCE_MIXING = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS position
  FROM documents),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT source, source_size, source_size * 3.0::DOUBLE AS cap,
         [1.0::DOUBLE, 2.0::DOUBLE, 3.0::DOUBLE][CAST((row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 AS INT) + 1] AS weight
  FROM totals),
levels AS (
  SELECT w.*, (SELECT sum(source_size) FROM weighted) AS total,
         coalesce(sum(cap) OVER before, 0) AS fixed, (SELECT sum(weight) FROM weighted) - coalesce(sum(weight) OVER before, 0) AS free
  FROM weighted w WINDOW before AS (ORDER BY cap / weight ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT coalesce(arg_min((total - fixed) / free, cap / weight) FILTER ((total - fixed) / free <= cap / weight), 0) AS level FROM levels),
wanted AS (SELECT source, source_size, least(weight * level, cap) AS target FROM weighted, level),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(least(floor(target / source_size), 3) AS BIGINT) ELSE 0 END AS repeats FROM wanted),
rest AS (SELECT *, CASE WHEN repeats >= 3 THEN 0 ELSE target - repeats * source_size END AS remains FROM plan),
positions AS (SELECT source, position, sum(size) AS words FROM sized GROUP BY source, position),
below AS (
  SELECT *, coalesce(sum(words) OVER (PARTITION BY source ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
  FROM positions),
edges AS (
  SELECT r.source, max(position) AS threshold, arg_max(words, position) AS words, any_value(remains) - arg_max(below, position) AS rest
  FROM rest r JOIN below b ON r.source IS NOT DISTINCT FROM b.source AND b.below <= r.remains GROUP BY r.source),
gaps AS (SELECT source, threshold, rest >= words AS edge_in, rest - CASE WHEN rest >= words THEN words ELSE 0 END AS gap FROM edges),
later AS (
  SELECT s.source, position, sum(size) AS words, any_value(gap) AS gap
  FROM sized s JOIN gaps g ON s.source IS NOT DISTINCT FROM g.source AND position > threshold AND size <= gap GROUP BY s.source, position),
later_below AS (
  SELECT *, coalesce(sum(words) OVER (PARTITION BY source ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
  FROM later),
fillers AS (
  SELECT source, max(position) AS gap_threshold, (any_value(gap) - arg_max(below, position)) * 2 >= arg_max(words, position) AS gap_edge_in
  FROM later_below WHERE below <= gap GROUP BY source),
chosen AS (
  SELECT doc_id, s.source, size, source_size, target, repeats + CASE WHEN repeats < 3 AND coalesce(
    position < threshold OR (position = threshold AND edge_in) OR (position > threshold AND size <= gap
      AND (position < gap_threshold OR (position = gap_threshold AND gap_edge_in))), false) THEN 1 ELSE 0 END AS copies
  FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source JOIN gaps g ON s.source IS NOT DISTINCT FROM g.source
  LEFT JOIN fillers f ON s.source IS NOT DISTINCT FROM f.source)
SELECT doc_id, source, size, source_size, target, CAST(size * copies AS BIGINT) AS taken, CAST(copies AS INT) AS copies FROM chosen
"""

BENCHMARK_DECONTAMINATION = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
sized AS (SELECT item_id, w, least(13, len(w)) AS width FROM item_words WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, width, unnest(list_transform(range(1, len(w) - width + 2), lambda i: array_to_string(w[i:i + width - 1], ' '))) AS s
  FROM sized),
widths AS (SELECT DISTINCT width FROM windows),
starts AS (
  SELECT doc_id, width, w, unnest(range(1, len(w) - width + 2)) AS i FROM doc_words, widths WHERE len(w) >= width),
found AS (
  SELECT doc_id, item_id, i, s.width FROM starts s
  JOIN windows n ON s.width = n.width AND array_to_string(s.w[s.i:s.i + s.width - 1], ' ') = n.s),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + width)) AS p FROM found) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM doc_words d LEFT JOIN hit h ON d.doc_id = h.doc_id LEFT JOIN named n ON d.doc_id = n.doc_id
"""

QUALITY_RULES = r"""
WITH texts AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(lang, '') AS language, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
classed AS (
  SELECT *, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars, length(regexp_replace(t, '[^a-z]', '', 'g')) AS c1,
         length(regexp_replace(t, '[^A-Z]', '', 'g')) AS c2, length(regexp_replace(t, '[^0-9]', '', 'g')) AS c3,
         length(regexp_replace(t, '[^.,;:!?''"()-]', '', 'g')) AS c4, length(regexp_replace(t, '[\x00-\x7F]', '', 'g')) AS c6
  FROM texts),
counted AS (
  SELECT k, doc_id, language, w, len(w) AS n_words, word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, length(t) AS n_chars,
         [length(t) - word_chars, c1, c2, c3, c4, word_chars - c1 - c2 - c3 - c4 - c6, c6] AS classes
  FROM classed),
windows AS (
  SELECT k, i, w[i] || chr(10) || w[i + 1] || chr(10) || w[i + 2] AS g
  FROM (SELECT k, w, unnest(range(1, len(w) - 1)) AS i FROM counted)),
again AS (SELECT k, i, count(*) OVER (PARTITION BY k, g) AS times FROM windows),
repeated AS (
  SELECT k, count(DISTINCT p) AS n_repeat_words FROM (SELECT k, unnest([i, i + 1, i + 2]) AS p FROM again WHERE times > 1) GROUP BY k),
tokens AS (SELECT k, language, unnest(w) AS word FROM counted),
forms AS (
  SELECT k, language, CASE WHEN length(word) <= 24 AND regexp_matches(word, '\p{L}') THEN lower(word) ELSE '' END AS word FROM tokens),
totals AS (SELECT language, count(*) AS total FROM forms WHERE language <> '' GROUP BY language HAVING count(*) >= 5000
           ORDER BY total DESC, language LIMIT 64),
top_words AS (
  SELECT language, word, n / total AS q FROM (
    SELECT language, word, count(*) AS n, row_number() OVER (PARTITION BY language ORDER BY count(*) DESC, word) AS place
    FROM forms WHERE word <> '' GROUP BY language, word) JOIN totals USING (language) WHERE place <= 32),
known AS (SELECT language, sum(q) AS q FROM top_words GROUP BY language),
own AS (SELECT k, word, count(*) AS n FROM forms WHERE word <> '' GROUP BY k, word),
word_parts AS (
  SELECT o.k, r.language, sum(n / n_words) AS p, sum(q) AS q,
         sum(n / n_words * log2(2 * (n / n_words) / (n / n_words + q)) + q * log2(2 * q / (n / n_words + q))) AS s
  FROM own o JOIN counted USING (k) JOIN top_words r ON r.word = o.word GROUP BY 1, 2),
word_distances AS (
  SELECT c.k, v.language, v.q AS held, coalesce(s, 0) + v.q - coalesce(x.q, 0) AS s, 1 - coalesce(x.p, 0) AS p
  FROM counted c CROSS JOIN known v LEFT JOIN word_parts x ON x.k = c.k AND x.language = v.language WHERE n_words > 0),
class_sums AS (
  SELECT language, list(s ORDER BY place) AS shares FROM (
    SELECT language, place, sum(classes[place]) / sum(sum(classes[place])) OVER (PARTITION BY language) AS s
    FROM (SELECT language, classes, unnest(range(1, 8)) AS place FROM counted) GROUP BY language, place) GROUP BY language),
class_parts AS (
  SELECT c.k, r.language, n_chars, unnest(list_transform(range(1, 8), lambda i: classes[i] / n_chars)) AS p, unnest(shares) AS q
  FROM counted c CROSS JOIN class_sums r WHERE n_words > 0),
class_distances AS (
  SELECT k, language, sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
                                      + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2, 0)) AS d
  FROM class_parts GROUP BY k, language),
near AS (
  SELECT k, arg_min(struct_pack(w := word_distance, c := d), (word_distance, d, language)) AS near FROM (
    SELECT k, language, d, sqrt(greatest((s + CASE WHEN p > 0 THEN p * log2(2 * p / (p + 1 - held)) ELSE 0 END
                                            + (1 - held) * log2(2 * (1 - held) / (p + 1 - held))) / 2, 0)) AS word_distance
    FROM word_distances JOIN class_distances USING (k, language)) GROUP BY k),
judged AS (
  SELECT c.*, coalesce(n_repeat_words, 0) AS n_repeat_words, near,
         n_words < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * n_words AS base_failed
  FROM counted c LEFT JOIN repeated USING (k) LEFT JOIN near USING (k))
SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND (language <> '' AND language NOT IN (SELECT language FROM totals)
         OR NOT coalesce(n_words >= 50 AND near.w > 0.42, false) AND NOT coalesce(n_chars >= 200 AND near.c > 0.28, false)) AS kept
FROM judged
"""

SPELLING_VARIANTS = r"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN (c & 1) = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, CAST(i AS BIGINT))) AS t),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]{7,}')) AS run
  FROM documents),
hexed AS (SELECT run, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x FROM runs),
hashed AS (
  SELECT run, xor(4294967295, list_reduce(
    list_transform(range(0, length(x), 2), lambda i: CAST('0x' || substr(x, CAST(i + 1 AS BIGINT), 2) AS BIGINT)),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), CAST(4294967295 AS BIGINT))) AS h
  FROM hexed, crc_table),
vocabulary AS (
  SELECT word, count(*) AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2),
cut AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, CAST(unnest(range(1, length(word) + 1)) AS BIGINT) AS i FROM vocabulary)),
near AS (
  SELECT a.word, b.word AS near, b.n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT c.word, v.word, v.n FROM cut c JOIN vocabulary v ON c.rest = v.word
  UNION SELECT v.word, c.word, c.n FROM cut c JOIN vocabulary v ON c.rest = v.word),
best AS (SELECT word, count(*) AS n_near, arg_min(struct_pack(near := near, n := n), (-n, near)) AS b FROM near GROUP BY word),
formed AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN b.n >= 10 * v.n THEN b.near END AS form, CASE WHEN b.n >= 10 * v.n THEN b.n END AS form_n
  FROM vocabulary v LEFT JOIN best ON v.word = best.word),
chain(word, root, depth) AS (
  SELECT word, word, 0 FROM formed
  UNION ALL SELECT c.word, f.form, depth + 1 FROM chain c JOIN formed f ON f.word = c.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, arg_max(c.root, c.depth) AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN chain c ON c.word = f.word GROUP BY f.word, f.form, f.n, f.n_near, f.form_n
"""
