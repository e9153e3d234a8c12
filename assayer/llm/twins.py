"""DuckDB SQL equal to queries of this package."""

QUALITY_RULES = r"""
WITH base AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS n
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM base)),
repeats AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
  FROM windows, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1 GROUP BY doc_id),
norm AS (
  SELECT doc_id, source, text,
         regexp_replace(trim(regexp_replace(lower(l), '[\x20\x09-\x0D]+', ' ', 'g'), ' '), '[0-9]', '0', 'g') AS line,
         len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS words
  FROM (SELECT doc_id, source, text, unnest(lines) AS l FROM base)),
hosts AS (SELECT source, count(DISTINCT text) AS n FROM base GROUP BY source),
frequent AS (
  SELECT l.source, l.line FROM (SELECT source, line, words, count(DISTINCT text) AS n FROM norm GROUP BY source, line, words) l
  JOIN hosts h ON l.source IS NOT DISTINCT FROM h.source
  WHERE l.n > greatest(10, CASE WHEN l.words >= 8 THEN least(0.1 * h.n, 1000) ELSE 0.1 * h.n END)),
removed AS (
  SELECT n.doc_id, sum(n.words) AS words FROM norm n JOIN frequent f
  ON n.line = f.line AND n.source IS NOT DISTINCT FROM f.source GROUP BY n.doc_id),
stats AS (
  SELECT b.doc_id, CAST(len(b.words) AS BIGINT) AS n_words, CAST(length(array_to_string(b.words, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(r.words, 0) AS BIGINT) AS n_removed_words
  FROM base b LEFT JOIN repeats USING (doc_id) LEFT JOIN removed r USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_words - n_removed_words >= 0.5 * n_words AS kept
FROM stats
"""

NGRAM_JOIN = r"""
WITH RECURSIVE base AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
texts AS (SELECT min(doc_id) AS tid, count(*) AS copies, words FROM base WHERE len(words) > 0 GROUP BY words),
grams AS (
  SELECT DISTINCT tid, hash(words[i:i + 4]) AS gram
  FROM (SELECT tid, words, unnest(range(1, greatest(2, len(words) - 3))) AS i FROM texts)),
sizes AS (SELECT tid, count(*) AS n FROM grams GROUP BY tid),
shared AS (SELECT a.tid AS a, b.tid AS b, count(*) AS n FROM grams a JOIN grams b ON a.gram = b.gram AND a.tid <> b.tid GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared s JOIN sizes x ON x.tid = a JOIN sizes y ON y.tid = b WHERE s.n / (x.n + y.n - s.n) >= 0.8),
reach AS (SELECT tid, tid AS other FROM texts UNION SELECT r.tid, l.b FROM reach r JOIN links l ON r.other = l.a),
classes AS (SELECT tid, min(other) AS class_id FROM reach GROUP BY tid),
degrees AS (SELECT a AS tid, sum(copies) AS docs, count(*) AS n FROM links JOIN texts t ON t.tid = b GROUP BY a)
SELECT b.doc_id, CASE WHEN t.tid IS NULL THEN b.doc_id ELSE c.class_id END AS class_id,
       CAST(CASE WHEN t.tid IS NULL THEN 0 ELSE coalesce(d.docs, 0) + t.copies - 1 END AS BIGINT) AS n_links,
       CAST(coalesce(d.n, 0) AS BIGINT) AS n_text_links,
       CASE WHEN t.tid IS NULL THEN TRUE ELSE b.doc_id = c.class_id END AS kept
FROM base b LEFT JOIN texts t ON b.words = t.words AND len(b.words) > 0
LEFT JOIN classes c USING (tid) LEFT JOIN degrees d USING (tid)
"""

EMBEDDING_DEDUP = """
WITH RECURSIVE vectors AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT vec_id, vec_id AS other FROM vectors UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a),
components AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
degrees AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM components LEFT JOIN degrees USING (vec_id)
"""


def _crc32(value: str) -> str:
    """The unsigned CRC-32 of a short ASCII text; DuckDB has no function for it."""
    step = "CASE WHEN b % 2 = 1 THEN xor(b >> 1, 3988292384) ELSE b >> 1 END"
    byte = f"list_reduce(list_prepend(xor(a, c), range(8)), lambda b, bit: {step})"
    codes = f"[CAST(ascii(c) AS BIGINT) for c in string_split(CAST({value} AS VARCHAR), '')]"
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda a, c: {byte}), 4294967295)"


PREFIX_TRIE = f"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, conv_id - conv_id % 5 AS first_of, {_crc32("conv_id")} % 9 AS h FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (
  SELECT c.conv_id, 0 AS part, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.first_of AND t.pos <= c.h
  UNION ALL
  SELECT conv_id, 1, t.pos, t.role, t.text FROM turns t JOIN convs c USING (conv_id) WHERE t.pos > c.h),
chain AS (
  SELECT conv_id, row_number() OVER w AS depth, list({{'role': role, 'text': text}}) OVER w AS prefix, strlen(text) AS bytes
  FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT conv_id, 0, [], 0 FROM convs),
ends AS (SELECT conv_id, max(depth) AS depth FROM chain GROUP BY conv_id),
named AS (
  SELECT conv_id, depth, bytes, min(conv_id) OVER n AS node, count(*) OVER n AS n_convs,
         e.depth IS NOT NULL AS ended
  FROM chain LEFT JOIN ends e USING (conv_id, depth) WINDOW n AS (PARTITION BY depth, prefix)),
nodes AS (
  SELECT node, depth, any_value(n_convs) AS n_convs, (any_value(n_convs) - 1) * any_value(bytes) AS saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ended), '')) AS ends_sha256
  FROM named GROUP BY node, depth),
parents AS (
  SELECT c.node, c.depth, p.node AS parent FROM nodes c LEFT JOIN named p ON p.conv_id = c.node AND p.depth = c.depth - 1),
children AS (SELECT parent AS node, depth - 1 AS depth, count(*) AS n FROM parents WHERE depth > 0 GROUP BY 1, 2),
below AS (
  SELECT v.node, v.depth, sum(u.saved) AS saved, count(*) FILTER (WHERE c.n IS NULL) AS leaves
  FROM nodes u JOIN named v ON v.conv_id = u.node AND v.depth <= u.depth
  LEFT JOIN children c ON c.node = u.node AND c.depth = u.depth GROUP BY v.node, v.depth)
SELECT CAST(n.node AS BIGINT) AS conv_id, CAST(n.depth AS BIGINT) AS depth, CAST(parent AS BIGINT) AS parent_conv_id,
       CAST(n_convs AS BIGINT) AS n_convs, CAST(coalesce(c.n, 0) AS BIGINT) AS n_children, CAST(leaves AS BIGINT) AS n_leaves,
       CAST(b.saved AS BIGINT) AS saved_tokens, ends_sha256
FROM nodes n JOIN parents USING (node, depth) JOIN below b USING (node, depth) LEFT JOIN children c USING (node, depth)
"""

SUBSTRING_DEDUP = r"""
WITH base AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
word AS (SELECT r, id, unnest(words) AS w, unnest(range(1, len(words) + 1)) AS i FROM base),
phrases AS (
  SELECT r, id, i, string_agg(w, ' ') OVER f AS phrase, count(*) OVER f AS n
  FROM word WINDOW f AS (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)),
windows AS (SELECT r, i, id, min(id) OVER (PARTITION BY phrase) AS least FROM phrases WHERE n = 13),
gone AS (SELECT DISTINCT r, i + k AS i FROM windows, (SELECT unnest(range(13)) AS k) WHERE least < id),
kept AS (
  SELECT r, string_agg(w, ' ' ORDER BY i) FILTER (WHERE g.r IS NULL) AS text, count(g.r) AS n
  FROM word LEFT JOIN gone g USING (r, i) GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM base LEFT JOIN kept k USING (r)
"""


def _field(name: str) -> str:
    return f"coalesce(strlen(CAST({name} AS VARCHAR)) || ':' || CAST({name} AS VARCHAR), '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field(f) for f in ("doc_id", "source", "lang", n_chars, "text")) + ")"


MERKLE_MANIFEST = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS tree, {_leaf("n_chars")} AS leaf,
         CASE WHEN doc_id IS NOT NULL AND {_crc32("coalesce(doc_id, 0)")} % 7 = 0 THEN {_leaf("(n_chars + 1)")} END AS checked
  FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY tree) AS total
  FROM leaves),
nodes AS (
  SELECT 0 AS level, tree, place, leaf AS digest, total FROM placed
  UNION ALL
  SELECT level + 1, tree, place // 2, sha256(string_agg(digest, '' ORDER BY place)), (total + 1) // 2
  FROM nodes WHERE total > 1 GROUP BY level, tree, place // 2, total),
tops AS (
  SELECT tree, digest, level AS height, row_number() OVER (ORDER BY tree) - 1 AS seat, count(*) OVER () AS total FROM nodes WHERE total = 1),
crown AS (
  SELECT 0 AS level, seat AS place, digest, total FROM tops
  UNION ALL
  SELECT level + 1, place // 2, sha256(string_agg(digest, '' ORDER BY place)), (total + 1) // 2
  FROM crown WHERE total > 1 GROUP BY level, place // 2, total),
levels AS (
  SELECT p.tree, p.place, l.level AS step FROM placed p JOIN (SELECT DISTINCT tree, level FROM nodes WHERE total > 1) l USING (tree)),
paths AS (
  SELECT tree, place, string_agg(digest, '' ORDER BY step) AS siblings,
         list(CASE WHEN digest IS NULL THEN 'N' WHEN side = 1 THEN 'L' || digest ELSE 'R' || digest END ORDER BY step) AS steps
  FROM (
    SELECT l.tree, l.place, l.step, (l.place >> l.step) % 2 AS side, n.digest
    FROM levels l LEFT JOIN nodes n ON n.tree = l.tree AND n.level = l.step AND n.place = xor(l.place >> l.step, 1)
    UNION ALL
    SELECT p.tree, p.place, t.height + l.level, (t.seat >> l.level) % 2, n.digest
    FROM placed p JOIN tops t USING (tree) CROSS JOIN (SELECT DISTINCT level FROM crown WHERE total > 1) l
    LEFT JOIN crown n ON n.level = l.level AND n.place = xor(t.seat >> l.level, 1))
  GROUP BY tree, place),
folded AS (
  SELECT p.doc_id, p.leaf, t.digest AS subroot, (SELECT digest FROM crown WHERE total = 1) AS root, sha256(coalesce(siblings, '')) AS proof_sha256,
         list_reduce(list_prepend(coalesce(checked, leaf), coalesce(steps, [])),
           lambda a, s: sha256(CASE s[1] WHEN 'L' THEN s[2:] || a WHEN 'R' THEN a || s[2:] ELSE a END)) AS folded_root
  FROM placed p JOIN tops t USING (tree) LEFT JOIN paths USING (tree, place))
SELECT *, folded_root = root AS verified FROM folded
"""
