"""SQL equivalents of the corpus queries, for an independent engine."""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BLANK = r"\x20\x09-\x0D"

ORACLE: dict[str, str] = {
    "op1_exact_dedup": rf"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[{_BLANK}]', '', 'g')) AS text_sha256
  FROM documents),
g AS (
  SELECT doc_id, text_sha256, count(*) OVER (PARTITION BY text_sha256) AS group_size,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS keep_id
  FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g""",
    "op6_quality_rules": rf"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^{_BLANK}]+') AS words FROM documents),
l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t),
d AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM l WHERE regexp_matches(line, '[^{_BLANK}]') GROUP BY doc_id),
w AS (
  SELECT doc_id, unnest(range(1, len(words) - 6)) AS i, words FROM t WHERE len(words) >= 8),
v AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(words[i:i + 7], ' ')) AS n FROM w),
p AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 8)) AS i FROM v WHERE n > 1),
r AS (
  SELECT doc_id, count(*) AS n_repeat_words FROM p GROUP BY doc_id),
m AS (
  SELECT t.doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[{_BLANK}]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM t LEFT JOIN d ON t.doc_id = d.doc_id LEFT JOIN r ON t.doc_id = r.doc_id)
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words OR 10 * n_symbols > n_words
            OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR 100 * n_dup_lines > 10 * n_words) AS kept
FROM m""",
    "op8_line_dedup": rf"""
WITH t AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM t),
k AS (
  SELECT doc_id, i, line,
         translate(regexp_replace(line, '^[{_BLANK}]+|[{_BLANK}]+$', '', 'g'), '{_UPPER}', '{_UPPER.lower()}') AS key
  FROM l),
s AS (
  SELECT key, max(doc_id) AS stays FROM k WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
f AS (
  SELECT doc_id, i, line, coalesce(doc_id <> stays, false) AS gone FROM k LEFT JOIN s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM f GROUP BY doc_id""",
    "op10_minhash_dedup": rf"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
                                    '[^{_BLANK}]+') AS words FROM documents),
x AS (
  SELECT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' ')) END) AS shingle FROM t),
s AS (SELECT DISTINCT doc_id, hash(shingle) AS shingle FROM x),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
b AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY 1, 2),
l AS (
  SELECT a, b FROM b JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * common >= 80 * (na.n + nb.n - common)),
r AS (
  SELECT doc_id AS node, doc_id AS root FROM t
  UNION
  SELECT l.b, r.root FROM r JOIN l ON l.a = r.node),
c AS (SELECT node, min(root) AS component_id FROM r GROUP BY node)
SELECT t.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, t.doc_id = c.component_id AS kept
FROM t JOIN c ON c.node = t.doc_id LEFT JOIN n ON n.doc_id = t.doc_id""",
    "op12_prefix_trie": rf"""
WITH t AS (
  SELECT conv_id, turn, sha256(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS key,
         len(regexp_extract_all(coalesce(text, ''), '[^{_BLANK}]+')) AS words
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (
  SELECT conv_id, list(key ORDER BY turn NULLS FIRST, key) AS keys, list(words ORDER BY turn NULLS FIRST, key) AS words
  FROM t GROUP BY conv_id),
c AS (
  SELECT *, xor(4294967295, list_reduce(
           list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
           lambda crc, x: list_reduce(CAST(range(8) AS BIGINT[]),
             lambda r, i: CASE WHEN r & 1 = 1 THEN xor(r >> 1, CAST(3988292384 AS BIGINT)) ELSE r >> 1 END, xor(crc, x)),
           CAST(4294967295 AS BIGINT))) % 4 AS h
  FROM o),
r AS (
  SELECT c.conv_id, list_concat(coalesce(b.keys[1:c.h], []), c.keys[c.h + 1:]) AS keys,
         list_concat(coalesce(b.words[1:c.h], []), c.words[c.h + 1:]) AS words
  FROM c LEFT JOIN o b ON b.conv_id = c.conv_id - c.conv_id % 20),
p AS (
  SELECT conv_id, keys, words, unnest(range(len(keys) + 1)) AS depth FROM r),
n AS (
  SELECT array_to_string(keys[1:depth], '') AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         max(CASE WHEN depth > 0 THEN words[depth] ELSE 0 END) AS words,
         coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(keys) = depth), '') AS ends
  FROM p GROUP BY ALL),
k AS (
  SELECT path[1:64 * (depth - 1)] AS path, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
m AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (path, depth)),
s AS (
  SELECT a.path, a.depth, count(*) FILTER (b.n_children = 0) AS n_leaves, sum((b.n_convs - 1) * b.words) AS saved_tokens
  FROM m a JOIN m b ON b.depth >= a.depth AND starts_with(b.path, a.path) GROUP BY ALL)
SELECT m.conv_id, m.depth, u.conv_id AS parent_conv_id, m.n_convs, m.n_children, s.n_leaves,
       CAST(s.saved_tokens AS BIGINT) AS saved_tokens, sha256(m.ends) AS ends_sha256
FROM m JOIN s USING (path, depth) LEFT JOIN m u ON m.depth > 0 AND u.depth = m.depth - 1 AND u.path = m.path[1:64 * (m.depth - 1)]""",
    "op13_chat_format": r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(24 + length(text) + len(regexp_extract_all(text, '<\\*\|'))
                + length(role) + len(regexp_extract_all(role, '[\\\n]|<\|'))) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id""",
}
